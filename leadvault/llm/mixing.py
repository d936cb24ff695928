"""Mixing sources to target weights with a low-discrepancy schedule.

Every source gets a target by weight, at most `most` times its size; what it can't take is shared by the
others. A source's documents are shuffled by hash and cut into blocks of equal words. The mix is a sequence
of slots: slot k has the golden-ratio point frac(k / phi), which the cumulative shares of the sources map to
a source, so every stretch of the mix holds each source near its share. The r-th slot of a source is joined
with its r-th block, and begins anew with the first block after the last one.

DataFrame operations only. A source may hold any share of the rows: ranks and positions are running totals
over slices (`with_running_total`), and slots meet blocks by (source, block)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadvault.llm.common import WORD, stored, with_running_total

WEIGHTS = (1, 2, 3)
MOST = 3
BLOCK_WORDS = 256
#: Rows that one slice of a running total holds, about.
SLICE_ROWS = 20_000
#: 2**31 and the odd number next to 2**31 / phi; k * STEP mod TURN visits every point once per turn.
TURN, STEP = 2**31, 1327217885

_SPREAD = 2**62 - 1


def sizes(docs: DataFrame, text: str = "text"):
    """Number of words per row; 0 for null and for texts without a word."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _ranked(spark: SparkSession, df: DataFrame, column: str) -> DataFrame:
    """Adds `rank`, from 0, by code point of `column` with null last. Ranges are sorted apart and offset by the
    row counts of the ranges before them."""
    spot = F.monotonically_increasing_id()
    sorted_ = stored(spark, df.orderBy(F.col(column).asc_nulls_last()).withColumn("_part", F.shiftright(spot, 33)).withColumn(
        "_spot", spot.bitwiseAND(F.lit(2**33 - 1))), "ranked")
    before = Window.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sorted_.groupBy(F.col("_part").alias("_at")).agg(F.count("*").alias("_n")).select(
        "_at", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))  # one row per range
    return sorted_.join(offsets, F.col("_part") == F.col("_at")).withColumn("rank", F.col("_offset") + F.col("_spot")).drop(
        "_part", "_spot", "_at", "_offset")


def targets(spark: SparkSession, sized: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) for `sized` (source, size). Weights are dealt to sources by code point, null
    last, repeating; targets add up to all sizes, none is above `most` times its source's size."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = stored(spark, _ranked(spark, sources, "source").withColumn("weight", weight), "weights")
    total, full = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    level, stopped = total / max(full, 1), 0
    while True:  # each round stops at least one more source, or is the last
        above = F.col("weight") * F.lit(float(level)) > F.col("source_size") * most
        n, spent, open_ = ranked.agg(F.count_if(above), F.coalesce(F.sum(F.when(above, F.col("source_size") * most)), F.lit(0)),
                                     F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))).first()
        if n == stopped or not open_:
            break
        level, stopped = (total - spent) / open_, n
    return ranked.select("source", "source_size", F.least(
        (F.col("source_size") * most).cast("double"), F.col("weight") * F.lit(float(level))).alias("target"))


def schedule(spark: SparkSession, wanted: DataFrame) -> DataFrame:
    """(slot, number, turn): for each source `number` with `slots` wanted, that many slots, spread by golden-ratio
    points over the mix; `turn` counts a source's slots from 0. What a source's points fall short of its slots
    (a few) comes at the end, what they exceed is left out."""
    n_sources, n = wanted.agg(F.count("*"), F.coalesce(F.sum("slots"), F.lit(0))).first()
    order = F.xxhash64("number").bitwiseAND(F.lit(_SPREAD))
    placed = stored(spark, with_running_total(
        spark, wanted.withColumn("_all", F.lit(0)).withColumn("_order", order), "_all", "_order", "slots", "low",
        n_sources // SLICE_ROWS + 1).select("number", "slots", "low", (F.col("low") + F.col("slots")).alias("high")), "shares")
    width = max(1, n // max(16_384, 4 * n_sources))
    bins = placed.where("slots > 0").select(
        "number", "low", "high", F.explode(F.sequence(F.expr(f"low div {width}"), F.expr(f"(high - 1) div {width}"))).alias("bin"))
    point = F.floor((F.col("slot") % TURN) * STEP % TURN / float(TURN) * float(n)).cast("long")
    slots = spark.range(n).withColumnRenamed("id", "slot").withColumn("x", point).withColumn("bin", F.expr(f"x div {width}"))
    drawn = slots.join(bins, "bin").where("x >= low and x < high").select("slot", "number")
    spread = max(1, 2**62 // max(n, 1))
    counted = with_running_total(
        spark, drawn.withColumn("_one", F.lit(1)).withColumn("_order", F.col("slot") * spread), "number", "_order", "_one", "turn",
        n // SLICE_ROWS + 1).select("slot", "number", "turn")
    counted = stored(spark, counted, "drawn")
    got = counted.groupBy("number").agg(F.count("*").alias("got"))
    kept = counted.join(placed.select("number", "slots"), "number").where("turn < slots").select("slot", "number", "turn")
    short = placed.join(got, "number", "left").withColumn("got", F.coalesce("got", F.lit(0))).where("got < slots").select(
        F.lit(n).alias("slot"), "number", F.explode(F.sequence("got", F.col("slots") - 1)).alias("turn"))
    return kept.unionByName(short)


def mix(spark: SparkSession, docs: DataFrame, weights=WEIGHTS, most: int = MOST, block: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """The mix of `docs` (doc_id, text, source, others ignored), and per document what it gives.

    First: (slot, turn, source, doc_id, start, words): slots in order hold `words` words of a document from its
    word `start` on. Second: (doc_id, source, size, source_size, target, taken) for every row of `docs`.
    A source's slots hold its target, rounded to words; each word is taken at most `most` times. Null texts
    have no words and are never taken; null is a source of its own; repeated rows count each; reruns agree."""
    sized = stored(spark, docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), sizes(docs).alias("size")), "sizes")
    aims = stored(spark, targets(spark, sized, weights, most).withColumn("number", F.xxhash64("source", F.isnull("source"))), "targets")
    quota = F.least(F.round("target").cast("long"), F.col("source_size") * most)
    aims = aims.withColumn("quota", quota).withColumn("blocks", F.expr(f"(source_size + {block - 1}) div {block}")).withColumn(
        "slots", F.expr(f"if(source_size = 0, 0, (quota div source_size) * blocks + (quota % source_size + {block - 1}) div {block})"))
    rows = sized.count()
    numbered = sized.withColumn("number", F.xxhash64("source", F.isnull("source")))
    order = F.xxhash64("doc_id", "size", "number").bitwiseAND(F.lit(_SPREAD))
    at = stored(spark, with_running_total(spark, numbered.where("size > 0").withColumn("_order", order), "number", "_order", "size", "at",
                                          rows // SLICE_ROWS + 1).drop("_order"), "positions")
    parts = at.select("number", "doc_id", "source", "at", "size", F.explode(
        F.sequence(F.expr(f"at div {block}"), F.expr(f"(at + size - 1) div {block}"))).alias("block"))
    parts = parts.select("number", "block", "doc_id", "source", "at", F.greatest("at", F.col("block") * block).alias("from"),
                         F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * block).alias("to"))
    slots = schedule(spark, aims.select("number", "slots")).join(
        aims.select("number", "source_size", "quota", "blocks"), "number").select(
        "slot", "turn", "number", F.expr("turn % blocks").alias("block"),
        F.expr("quota - (turn div blocks) * source_size").alias("stop"))  # words of this round through the source
    words = F.least("to", "stop") - F.col("from")
    mixed = slots.join(parts.hint("merge"), ["number", "block"]).where(words > 0).select(
        "slot", "turn", "number", "source", "doc_id", "at", (F.col("from") - F.col("at")).alias("start"), words.alias("words"))
    mixed = stored(spark, mixed, "mix")
    taken = mixed.groupBy("number", "at").agg(F.sum("words").alias("taken"))
    given = at.join(taken, ["number", "at"], "left").select("number", "doc_id", "source", "size", F.coalesce("taken", F.lit(0)).alias("taken"))
    given = given.unionByName(numbered.where("size = 0").select("number", "doc_id", "source", "size", F.lit(0).cast("long").alias("taken")))
    per_doc = given.join(aims.select("number", "source_size", "target"), "number").drop("number")
    return mixed.drop("number", "at"), per_doc
