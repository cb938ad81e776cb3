"""Secrets and who owns them, from DataFrame functions only.

Candidates are the matches of three base patterns (assign, access, hex) and of further token forms.  Their values are hashed and counted
over the whole corpus: in how many repositories and by how many owners each appears.  A value that many owners hold, or many repositories of one, is a copied example; one
that a single owner (or a few) holds and that looks random is a live-looking credential.

Counts are aggregates that combine before each exchange, so a value in a third of all rows is one row per task.  Verdicts come
back by a join on the hash, which adaptive skew handling may split; candidates carry no text.  Base matches always stay; further forms are added
where they are live-looking and no base match covers part of them.  Defined results: a null text is empty; a null owner or repository counts
as one of its own; repeated rows are scanned each for itself and count once as a repository.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from homelake.llm.common import table
from homelake.llm.spans import Pattern, span_text, with_spans
from homelake.session import cut_lineage

# A value held by this many owners, or in this many repositories of whoever owns them, is an example that was copied around.
EXAMPLE_OWNERS = 3
EXAMPLE_REPOSITORIES = 10
_ASSIGN = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*+[:=]\x20*+[\"']?([A-Za-z0-9+/_.=-]++)"

# The quantifiers are possessive and minimum lengths are part of the pattern where that changes no match, for speed.
BASE = [
    Pattern("assign", _ASSIGN, lambda v: F.length(F.regexp_extract(v, _ASSIGN, 1)) >= 12),
    Pattern("access", r"AKIA[A-Z0-9]{14,}+"),
    Pattern("hex", r"(?<![0-9a-f])[0-9a-f]{16,}+"),
]
FURTHER = [
    Pattern("bearer", r"(?i:bearer)\x20++[A-Za-z0-9._~+/-]{20,}+=*+"),
    Pattern("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+"),
    Pattern("private_key", r"-----BEGIN (?:[A-Z]++\x20)*+PRIVATE KEY-----"),
    Pattern("prefixed", r"(?<![A-Za-z0-9])(?:gh[opsu]|glpat|xox[abprs]|[sr]k_live|npm|AIza)[_-]?[A-Za-z0-9_-]{16,}+"),
]
KINDS = [p.kind for p in BASE + FURTHER]


def secret_value(kind: Column, match: Column) -> Column:
    """What is secret in a match: the value of an assignment or header, else the match itself."""
    return (
        F.when(kind == "assign", F.regexp_extract(match, _ASSIGN, 1))
        .when(kind == "bearer", F.regexp_extract(match, r"\x20([^\x20]+)$", 1)).otherwise(match)
    )


def looks_random(value: Column) -> Column:
    """At least ten different characters, letters as well as digits, and no word of a placeholder."""
    different = F.size(F.array_distinct(F.split(value, "")))
    return (different >= 10) & value.rlike("[0-9]") & value.rlike("[A-Za-z]") & ~value.rlike("(?i)example|changeme|placeholder|your|xxxx|dummy|sample")


def scan_secrets(docs: DataFrame, owner: str, repository: str, text: str = "text") -> DataFrame:
    """``docs`` without the text, with row_id and ``candidates``: (kind, start, end, base, hash, random); stored once, read by all that follows."""
    found = with_spans(docs, BASE + FURTHER, text)
    certain = F.concat(*[F.col(f"__span_{p.kind}") for p in BASE])

    def candidates(pattern: Pattern, base: bool) -> Column:
        spans = F.col(f"__span_{pattern.kind}")
        if not base:
            spans = F.filter(spans, lambda s: ~F.exists(certain, lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))
        value = lambda s: secret_value(F.lit(pattern.kind), s["value"])
        return F.transform(spans, lambda s: F.struct(
            F.lit(pattern.kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit(base).alias("base"),
            F.sha2(value(s), 256).alias("hash"), looks_random(value(s)).alias("random")))

    every = F.concat(*[candidates(p, True) for p in BASE], *[candidates(p, False) for p in FURTHER])
    kept = [name for name in docs.columns if name not in (text, owner, repository)]
    slim = found.select(
        F.monotonically_increasing_id().alias("row_id"), *kept, F.col(owner).cast("string").alias("owner"),
        F.col(repository).cast("string").alias("repository"), every.alias("candidates"))
    return cut_lineage(slim)


def ownership(scanned: DataFrame) -> DataFrame:
    """hash, repositories and owners of every candidate value: distinct places, then per owner, then per value."""
    places = scanned.select(F.explode("candidates").alias("c"), "owner", "repository").select("c.hash", "owner", "repository").distinct()
    owned = places.groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    return owned.groupBy("hash").agg(F.sum("repositories").alias("repositories"), F.count("*").alias("owners"))


def judged_secrets(scanned: DataFrame) -> DataFrame:
    """One row per candidate: row_id, kind, start, end, base, hash, repositories, owners and verdict (example, live or plain)."""
    rows = scanned.select("row_id", F.explode("candidates").alias("c")).select("row_id", "c.*")
    copied = (F.col("owners") >= EXAMPLE_OWNERS) | (F.col("repositories") >= EXAMPLE_REPOSITORIES)
    verdict = F.when(copied, "example").when(F.col("random"), "live").otherwise("plain")
    return rows.join(ownership(scanned), "hash").withColumn("verdict", verdict)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Besides the contract's columns: ``verdicts`` (kind:start:end:verdict of every candidate, in order of place), ``n_live`` and ``n_example``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", F.col("doc_id").alias("repository"))
    scanned = scan_secrets(docs, "source", "repository")
    place = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    judged = judged_secrets(scanned).groupBy("row_id").agg(
        F.array_sort(F.collect_list(F.struct("start", place.alias("place"), "end", "kind", "base", "verdict"))).alias("judged"))
    found = scanned.join(judged, "row_id", "left")
    every = F.coalesce("judged", F.array().cast("array<struct<start:int,place:int,end:int,kind:string,base:boolean,verdict:string>>"))
    base = F.filter(every, lambda c: c["base"])
    shown = F.filter(every, lambda c: c["base"] | (c["verdict"] == "live"))
    verdicts = F.transform(every, lambda c: F.concat_ws(":", c["kind"], c["start"].cast("string"), c["end"].cast("string"), c["verdict"]))

    def count(name: str, what: Column) -> Column:
        return F.size(what).cast("long").alias(name)

    def of_kind(kind: str) -> Column:
        return F.filter("candidates", lambda c: c["kind"] == kind)

    return found.select(
        "doc_id", *[count(f"n_{p.kind}", of_kind(p.kind)) for p in BASE],
        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(shown).alias("spans"), F.array_join(verdicts, ",").alias("verdicts"),
        count("n_live", F.filter(every, lambda c: c["verdict"] == "live")), count("n_example", F.filter(every, lambda c: c["verdict"] == "example")))
