"""Every operator as a query on the shared test tables, with the SQL that must give the same rows."""

from homelake.checks import bronze, layers, records, relational, scalars
from homelake.checks.common import Check

CHECKS: dict[str, Check] = {**relational.CHECKS, **scalars.CHECKS, **records.CHECKS, **layers.CHECKS, **bronze.CHECKS}

__all__ = ["CHECKS", "Check"]
