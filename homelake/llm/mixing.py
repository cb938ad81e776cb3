"""Mixing sources to target weights by a low-discrepancy schedule.

1. Targets: sources in code point order weigh 1, 2, 3, 1, ... and share all words; a source stops at ``MAX_REPEATS`` times its own
   words and the excess goes to the others by weight, until none is above.
2. Schedule: slot n falls at the van der Corput point of n on the line of cumulated targets and so belongs to a source.  A source's slots are
   ranked; it takes them until it has met its target, the last one cut.  Slots that fall to a source beyond that are left out of the mix.
3. Blocks: a source's documents, shuffled by a hash of their ids, form one stream of words, cut into blocks of equal length
   (``BLOCK_WORDS``, up to rounding).  Slot r takes block r modulo the number of blocks; a document's words in a taken block are taken.

Everything is joins, sums and short windows in Spark: streams are added up in two levels (parts of about ``PART_ROWS`` documents, then
documents), slots are ranked in two levels (runs of ``RUN_SLOTS``, then slots), so no task holds a source or the schedule.  The results depend
on ids and texts only.  Defined results: a null text has size 0; a null source is a source of its own and the last one; documents of size 0 take
nothing; repeated rows are documents of their own; without words all targets are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from homelake.llm.common import table
from homelake.session import cut_lineage

MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)
BLOCK_WORDS = 256
PART_ROWS = 500
RUN_SLOTS = 4096
CELLS = 4096
_BITS = 48
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def _running(df: DataFrame, key: list[str], order: list[str], value: str, output: str) -> DataFrame:
    """``output``: sum of ``value`` over the rows before."""
    before = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(output, F.coalesce(F.sum(value).over(before), F.lit(0)))


def _ranked(df: DataFrame, order: Column) -> DataFrame:
    """``rank`` (from 0) of all rows in order: ranges are counted, then each is numbered for itself."""
    ranged = cut_lineage(df.repartitionByRange(order).withColumn("__range", F.spark_partition_id()))
    counts = ranged.groupBy("__range").agg(F.count("*").alias("__n"))
    ahead = _running(counts.withColumn("__all", F.lit(0)), ["__all"], ["__range"], "__n", "__ahead").select("__range", "__ahead")
    within = F.row_number().over(Window.partitionBy("__range").orderBy(order)) - 1
    return ranged.withColumn("__within", within).join(ahead, "__range").withColumn("rank", F.col("__ahead") + F.col("__within")).drop(
        "__range", "__within", "__ahead")


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, number, rows, source_size, blocks and target of every source of ``sizes`` (source, size)."""
    sources = sizes.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size"))
    ranked = _ranked(sources, F.col("source").asc_nulls_last())
    weights = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    blocks = F.greatest(F.ceil(F.col("source_size") / BLOCK_WORDS), F.lit(1)).cast("long")
    weighed = cut_lineage(
        ranked.withColumns({"weight": weights.cast("double"), "blocks": blocks}).withColumnRenamed("rank", "number"))
    most = F.col("source_size") * MAX_REPEATS
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    # Words per unit of weight grow until no further source goes over its limit; every round is one sum over the sources.
    level, full = 0.0, -1
    while True:
        above = most < F.lit(level) * F.col("weight")
        state = weighed.agg(
            F.count_if(above).alias("full"), F.sum(F.when(above, most).otherwise(0)).alias("given"),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if state["full"] == full or not state["open"]:
            break
        full, level = state["full"], (total - state["given"]) / state["open"]
    return weighed.withColumn("target", F.least(most.cast("double"), F.lit(level) * F.col("weight"))).drop("weight")


def _point(slot: Column) -> Column:
    """Van der Corput point of a number in base 2: its binary digits behind the point, last digit first."""
    return F.conv(F.reverse(F.lpad(F.bin(slot), _BITS, "0")), 2, 10).cast("long") / F.lit(float(1 << _BITS))


def _edge(block: Column) -> Column:
    """First word of a block in its source's stream; the first blocks take the remainder, a word each."""
    short, longer = F.greatest(F.floor(F.col("source_size") / F.col("blocks")), F.lit(1)), F.col("source_size") % F.col("blocks")
    return block * short + F.least(block, longer)


def _block_of(word: Column) -> Column:
    short, longer = F.greatest(F.floor(F.col("source_size") / F.col("blocks")), F.lit(1)), F.col("source_size") % F.col("blocks")
    begun = longer * (short + 1)
    return F.when(word < begun, F.floor(word / (short + 1))).otherwise(longer + F.floor((word - begun) / short))


def _edged(sources: DataFrame) -> DataFrame:
    """``low``: needs of the sources before; summed in runs of ``RUN_SLOTS`` sources, then within a run."""
    runs = sources.withColumn("run", F.floor(F.col("number") / RUN_SLOTS))
    sums = runs.groupBy("run").agg(F.sum("need").alias("needs")).withColumn("__all", F.lit(0))
    ahead = _running(sums, ["__all"], ["run"], "needs", "ahead").select("run", "ahead")
    within = _running(runs, ["run"], ["number"], "need", "within").join(ahead, "run")
    return within.withColumn("low", F.col("ahead") + F.col("within")).drop("run", "ahead", "within")


def _slots_of(points: DataFrame, share: DataFrame, cells: int) -> DataFrame:
    """(number, slot) of the points (slot, point) that fall to one of the sources in ``share`` (number, low, high on the line from 0 to 1)."""
    # Both sides meet in cells of equal width, an equal join instead of a range join; a cell holds few edges of sources.
    first, last = F.floor(F.col("low") * cells), F.least(F.floor(F.col("high") * cells), F.lit(cells - 1))
    spread = share.withColumn("cell", F.explode(F.sequence(first, F.greatest(first, last))))
    inside = (F.col("point") >= F.col("low")) & (F.col("point") < F.col("high"))
    return points.withColumn("cell", F.floor(F.col("point") * cells)).join(spread, "cell").where(inside).select("number", "slot")


def _schedule(spark: SparkSession, sources: DataFrame) -> DataFrame:
    """(number, place, slot): the slots that fall to each source, ranked; a source takes them until it has as many as it needs.

    As many points as all sources need are mapped through the cumulated needs.  A source's share of them is off by about log2(slots) at
    most, so some are still short; the sequence goes on for these alone.  Any stretch of the line of length x holds a dyadic one of
    x / 4, which is met once in 4 / x points: after four times the needed number no source is short.
    """
    needed, count = sources.agg(F.sum("need"), F.count("*")).first()
    needed, cells = needed or 0, max(CELLS, 1 << (4 * count).bit_length())
    width = F.lit(float(needed or 1))
    share = cut_lineage(_edged(sources).where("need > 0").select(
        "number", "need", (F.col("low") / width).alias("low"), ((F.col("low") + F.col("need")) / width).alias("high")))

    def points(start: int, end: int) -> DataFrame:
        return spark.range(start, end).select(F.col("id").alias("slot"), _point(F.col("id")).alias("point"))

    found = cut_lineage(_slots_of(points(0, needed), share.drop("need"), cells))
    have = found.groupBy("number").agg(F.count("*").alias("have"))
    short = cut_lineage(share.join(have, "number", "left").where(F.coalesce("have", F.lit(0)) < F.col("need")).drop("need", "have"))
    every = cut_lineage(found.unionByName(_slots_of(points(needed, 4 * needed), short, cells)).withColumn("run", F.floor(F.col("slot") / RUN_SLOTS)))
    runs = every.groupBy("number", "run").agg(F.count("*").alias("n"))
    ahead = _running(runs, ["number"], ["run"], "n", "ahead").drop("n")
    within = F.row_number().over(Window.partitionBy("number", "run").orderBy("slot")) - 1
    ranked = every.withColumn("within", within).join(ahead, ["number", "run"])
    return ranked.select("number", (F.col("ahead") + F.col("within")).alias("place"), "slot")


def mix_sources(docs: DataFrame, text: str = "text", source: str = "source", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, source_size, target, taken and first_slot of every row of ``docs``, and its columns ``keep`` (of names of their own).

    ``first_slot`` is where a document first stands in the mix, null if it is not taken: in that order any stretch of the mix holds the sources in their shares.
    """
    spark = docs.sparkSession
    # The text tells apart rows without id or of one id.
    content = F.xxhash64("doc_id", text, F.lit("shuffle"))
    sizes = cut_lineage(docs.select("doc_id", *keep, F.col(source).alias("source"), word_count(text).alias("size"), content.alias("shuffled")))
    # A source's goal in whole words, and how many slots reach it: whole passes over its blocks, then the blocks of the rest.
    goal, rest = F.round("target").cast("long"), F.col("goal") % F.greatest("source_size", F.lit(1))
    passes = F.floor(F.col("goal") / F.greatest("source_size", F.lit(1))) * F.col("blocks")
    need = F.when(rest > 0, passes + _block_of(rest - 1) + 1).otherwise(passes)
    sources = cut_lineage(source_targets(sizes).withColumn("goal", goal).withColumn("need", need))

    # Where each document stands in its source's stream.
    at = sizes.alias("d").join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).select(
        "d.doc_id", *[f"d.{name}" for name in keep], "d.size", "d.shuffled", "s.number", "s.source_size", "s.target", "s.rows", "s.blocks")
    parts = F.ceil(F.col("rows") / PART_ROWS)
    # Order of parts is order of the upper hash bits, so parts are runs of the shuffled order.
    part = F.floor((F.shiftrightunsigned("shuffled", 32)) * parts / F.lit(float(1 << 32)))
    dealt = cut_lineage(at.withColumn("part", part))
    sums = dealt.groupBy("number", "part").agg(F.sum("size").alias("words"))
    ahead = _running(sums, ["number"], ["part"], "words", "ahead").drop("words")
    order = ["shuffled", "doc_id", "size"]
    within = _running(dealt, ["number", "part"], order, "size", "within").withColumn(
        "nth", F.row_number().over(Window.partitionBy("number", "part").orderBy(*order)))
    stood = within.join(ahead, ["number", "part"]).withColumn("first", F.col("ahead") + F.col("within"))

    # A document's words by block: block j covers the words from edge(j) to edge(j + 1) of the stream.
    end = F.col("first") + F.col("size")
    touched = F.when(F.col("size") > 0, F.sequence(_block_of(F.col("first")), _block_of(end - 1)))
    pieces = stood.withColumn("block", F.explode_outer(touched)).withColumns({
        "from": F.greatest(F.col("first"), _edge(F.col("block"))), "to": F.least(end, _edge(F.col("block") + 1)), "base": _edge(F.col("block")),
        "length": _edge(F.col("block") + 1) - _edge(F.col("block")),
    })

    # Whole takes of each block, and the one slot of each source that is cut to meet the target.
    goals = sources.select("number", "source_size", "blocks", "goal", "need")
    slots = _schedule(spark, goals).join(goals, "number").where("place < need").withColumn("block", F.col("place") % F.col("blocks"))
    start = F.floor(F.col("place") / F.col("blocks")) * F.col("source_size") + _edge(F.col("block"))
    width = _edge(F.col("block") + 1) - _edge(F.col("block"))
    used = slots.withColumn("words", F.least(width, F.col("goal") - start)).where("words > 0")
    takes = used.groupBy("number", "block").agg(
        F.count_if(F.col("words") == width).alias("whole"), F.min(F.when(F.col("words") == width, F.col("slot"))).alias("whole_slot"),
        F.min(F.when(F.col("words") < width, F.col("slot"))).alias("cut_slot"), F.coalesce(F.max(F.when(F.col("words") < width, F.col("words"))), F.lit(0)).alias("cut"))
    taken = F.col("whole") * (F.col("to") - F.col("from")) + F.greatest(
        F.least(F.col("to"), F.col("base") + F.col("cut")) - F.col("from"), F.lit(0))
    reached = F.when(F.col("from") < F.col("base") + F.col("cut"), F.col("cut_slot"))
    return (
        pieces.join(takes, ["number", "block"], "left")
        .withColumns({"words": F.coalesce(taken, F.lit(0)), "slot": F.when(F.col("to") > F.col("from"), F.least("whole_slot", reached))})
        .groupBy("number", "part", "nth").agg(
            F.first("doc_id").alias("doc_id"), *[F.first(name).alias(name) for name in keep], F.first("size").alias("size"), F.first("source_size").alias("source_size"),
            F.first("target").alias("target"), F.sum("words").cast("long").alias("taken"), F.min("slot").alias("first_slot"))
        .drop("number", "part", "nth")
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
