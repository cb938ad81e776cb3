"""Arguments and work folder of the jobs."""

import os

import pytest

from homelake.plans import jobs
from homelake.session import cut_lineage, remove_stored, shared_folder


def test_a_job_names_what_it_lacks(capsys):
    with pytest.raises(SystemExit):
        jobs.main(["gold", "--silver-dir", "s"])
    assert "--gold-dir" in capsys.readouterr().err


def test_off_a_local_session_a_shared_folder_is_required(spark, monkeypatch):
    class Elsewhere:
        conf = spark.conf

        class sparkContext:  # noqa: N801
            master = "local-cluster[2,1,1024]"

    monkeypatch.setattr(Elsewhere, "conf", {"spark.checkpoint.dir": None})
    with pytest.raises(ValueError, match="work-dir"):
        shared_folder(Elsewhere)
    assert jobs.job_conf(None, "/shared")["spark.checkpoint.dir"] == "/shared"


def test_stored_tables_go_at_the_end(spark):
    remove_stored(spark)
    before = set(os.listdir(shared_folder(spark)))
    assert cut_lineage(spark.range(3)).count() == 3
    assert set(os.listdir(shared_folder(spark))) > before
    remove_stored(spark)
    assert set(os.listdir(shared_folder(spark))) == before
