"""Entry points: paths in, tables out.

    python -m homelake.plans.jobs silver --bronze-dir B --silver-dir S
    python -m homelake.plans.jobs gold --silver-dir S --gold-dir G
    python -m homelake.plans.jobs features --silver-dir S --gold-dir G
    python -m homelake.plans.jobs ingest --responses-dir R --bronze-dir B --run-id 20240131_060000

Each takes --shuffle-partitions N, the number of partitions a shuffle starts with, and --work-dir W, a folder all executors share for
intermediate tables, which are removed when the job ends; off a local session it has to be named here or in spark.checkpoint.dir.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from homelake.plans.features import write_features
from homelake.plans.ingest import ingest
from homelake.plans.silver import write_silver
from homelake.plans.states import write_gold
from homelake.session import build_session, remove_stored, shared_folder
from homelake.sources import read_tables

RESPONSES = ["pages", "quick_filter", "details", "price_history", "price_charts"]


def run_ingest(spark: SparkSession, responses_dir: str, bronze_dir: str, run_id: str) -> dict[str, int]:
    return ingest(spark, bronze_dir, run_id, **read_tables(spark, responses_dir, RESPONSES))


# What each job has to be given.
NEEDED = {
    "ingest": ["responses_dir", "bronze_dir", "run_id"], "silver": ["bronze_dir", "silver_dir"], "gold": ["silver_dir", "gold_dir"],
    "features": ["silver_dir", "gold_dir"],
}


def job_conf(shuffle_partitions: int | None, work_dir: str | None = None) -> dict[str, str]:
    """Shuffle settings of the jobs: start with many partitions and let Spark merge them to about 128 MB each.

    ``shuffle_partitions`` is the starting number, about shuffled bytes / 128 MB; the session's own by default.
    """
    conf = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(shuffle_partitions)
    if work_dir:
        conf["spark.checkpoint.dir"] = work_dir
    return conf


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="homelake")
    parser.add_argument("job", choices=["ingest", "silver", "gold", "features"])
    for name in ("responses-dir", "bronze-dir", "silver-dir", "gold-dir", "run-id", "work-dir"):
        parser.add_argument(f"--{name}")
    parser.add_argument("--months", help="price columns of the feature table, comma-separated; looked up if not given")
    parser.add_argument("--runs", help="run stamps, comma-separated: the silver job brings only their listings into the listing table it keeps")
    parser.add_argument("--shuffle-partitions", type=int)
    args = parser.parse_args(argv)
    missing = [name for name in NEEDED[args.job] if not getattr(args, name)]
    if missing:
        parser.error(f"{args.job} needs " + ", ".join("--" + name.replace("_", "-") for name in missing))
    spark = build_session(f"homelake-{args.job}", conf=job_conf(args.shuffle_partitions, args.work_dir))
    shared_folder(spark)  # refuse before any work
    try:
        if args.job == "ingest":
            print(run_ingest(spark, args.responses_dir, args.bronze_dir, args.run_id))
        elif args.job == "silver":
            write_silver(spark, args.bronze_dir, args.silver_dir, args.runs.split(",") if args.runs else None)
        elif args.job == "gold":
            write_gold(spark, args.silver_dir, args.gold_dir)
        else:
            write_features(spark, args.silver_dir, args.gold_dir, args.months.split(",") if args.months else None)
    finally:
        remove_stored(spark)


if __name__ == "__main__":
    main()
