"""Corpus pipeline: toxicity, near-duplicates, benchmark decontamination, personal data, source mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is stored as Parquet and read again before the next one.  All stages but
the last return the columns of ``docs``.  Null texts, null ids and repeated rows are treated as the operators of :mod:`homelake.llm` state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homelake.llm.common import table
from homelake.llm.decontamination import find_contamination
from homelake.llm.mixing import mix_sources
from homelake.llm.near_dedup import near_duplicates
from homelake.llm.pii import redact_documents
from homelake.llm.toxicity import fit_on_training_folds, score_toxicity
from homelake.session import cut_lineage, stage_result

# Least similarity of near-duplicates, in percent.
SIMILARITY = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    model = fit_on_training_folds(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model, score="__score", predicted="__toxic").where("__toxic = 0").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that of smallest id (rows without id last); every row is judged by its own text, whatever ids it shares."""
    numbered = cut_lineage(docs.withColumn("__row", F.monotonically_increasing_id()))
    found = near_duplicates(numbered.select(F.col("__row").alias("doc_id"), "text"), percent=SIMILARITY)
    groups = cut_lineage(found.select(F.col("doc_id").alias("__row"), F.col("component_id").alias("__group")))
    several = groups.groupBy("__group").agg(F.count("*").alias("__rows")).where("__rows > 1").select("__group")
    members = cut_lineage(groups.join(several, "__group").join(numbered.select("__row", "doc_id"), "__row"))
    first = members.groupBy("__group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row")).alias("__first"))
    others = members.join(first, "__group").where(F.col("__row") != F.col("__first.__row")).select("__row")
    return numbered.join(others, "__row", "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"), prefix="__")
    return found.where("__n_hit = 0").select(docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the new text."""
    redacted = redact_documents(docs)
    return redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else redacted


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes, with size, source_size, target, taken words (repeats counted) and their first slot in the mix."""
    new = ("size", "source_size", "target", "taken", "first_slot")
    numbered = cut_lineage(docs.drop(*new).withColumn("__row", F.monotonically_increasing_id()))
    mixed = mix_sources(numbered.select("__row", "doc_id", "source", "text"), keep=("__row",)).where("taken > 0")
    return numbered.join(mixed.select("__row", *new), "__row").drop("__row")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("mix", mix),
]

# The stages train classifiers and walk graphs, which SQL cannot express; tests compare the chain with a plain version, given the classifiers' decisions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        last = at + 1 == len(STAGES)
        docs = stage(spark, docs, sf_dir) if last else stage_result(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
    return docs
