"""Near duplicates by SimHash: 64-bit fingerprints of word shingles, linked at few differing bits.

Pigeonhole blocks: the 64 bits are cut into m blocks. Two fingerprints that differ in at most d bits
agree on at least m - d whole blocks, so they meet under one of the C(m, d) keys made of m - d blocks.
Keys are joined, the bit distance is verified. Copies share a fingerprint and are one node, and m grows
with the number of fingerprints so that keys stay selective.

A key under which very many fingerprints meet (a large group of near copies) is not expanded into pairs.
Its fingerprints are linked through midpoints: two fingerprints at distance <= d have a common point at
distance <= d/2 from both, and two fingerprints with such a common point are at distance <= d. Linking
each point's members to the smallest one therefore yields links only, and loses no connection; the
work is one row per fingerprint and point, never per pair."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadvault.llm.common import connected, stored

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Keys with more fingerprints than this are linked by midpoints, the others pair by pair.
PAIRWISE = 32

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_CHUNK = 1 << 15


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash. A-Z are lower-cased; a text with fewer words is one shingle; none: 0."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not found:
        return 0
    if len(found) < words:
        shingles, n = iter([b" ".join(found)]), 1
    else:
        shingles, n = map(b" ".join, zip(*(islice(found, k, None) for k in range(words)))), len(found) - words + 1
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    while part := [digest(x, SEED) for x in islice(shingles, _CHUNK)]:
        bits = np.unpackbits(np.array(part, np.dtype("<u8")).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, copy: Column | None = None) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long, one row per row of `docs`; with `copy`, a long, as a third column."""
    names = ["doc_id", "fp"] + ([] if copy is None else ["copy"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), words) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64)), *batch.columns[2:]], names)

    read = docs.select(F.col("doc_id").cast("long"), "text", *([] if copy is None else [copy.alias("copy")]))
    return read.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _masks(blocks: int, bits: int) -> list[int]:
    """For each choice of blocks - bits of the blocks, the mask of their bits (signed)."""
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    whole = [(1 << cuts[k + 1]) - (1 << cuts[k]) for k in range(blocks)]
    masks = [sum(chosen) for chosen in combinations(whole, blocks - bits)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def _blocks_for(n: int, bits: int) -> int:
    """The fewest blocks whose keys have about as many values as there are fingerprints."""
    blocks = bits + 1
    while blocks < 2 * bits and n > 2 ** (64 * (blocks - bits) / blocks):
        blocks += 1
    return blocks


def links(spark: SparkSession, fps: DataFrame, bits: int = MAX_BITS, pairwise: int = PAIRWISE) -> DataFrame:
    """Edges (a, b) between distinct fingerprints `fps` (fp long) that connect exactly those joined by
    a chain of steps of at most `bits` differing bits (an even number)."""
    masks = _masks(_blocks_for(fps.count(), bits), bits)
    keyed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("choice", "key"))
    crowd = keyed.groupBy("choice", "key").agg(F.count("*").alias("n")).where("n > 1")
    met = stored(spark, keyed.join(crowd, ["choice", "key"]), "met")
    few = met.where(F.col("n") <= pairwise)
    left, right = few.select("choice", "key", F.col("fp").alias("a")), few.select("choice", "key", F.col("fp").alias("b"))
    near = left.join(right, ["choice", "key"]).where((F.col("a") < F.col("b")) & (
        F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits)).select("a", "b")
    many = met.where(F.col("n") > pairwise).select("fp").distinct()
    points = many.select("fp", F.col("fp").alias("point"), F.lit(-1).alias("last"))
    for _ in range(bits // 2):
        points = points.select("fp", "point", F.explode(F.expr("sequence(least(last + 1, 64), 64)")).alias("last")).select(
            "fp", F.expr("if(last = 64, point, point ^ shiftleft(1L, last))").alias("point"), "last")
    points = points.select("fp", "point")
    least = points.groupBy("point").agg(F.min("fp").alias("a"), F.max("fp").alias("top")).where("a < top").select("point", "a")
    # Spark can't foresee how many points there are: no broadcast here.
    through = points.join(least.hint("merge"), "point").where("fp <> a").select("a", F.col("fp").alias("b"))
    return near.unionByName(through).distinct()


def _rooted(spark: SparkSession, own: DataFrame, bits: int) -> DataFrame:
    """(fp, first, root) per fingerprint of `own` (doc_id, fp): its smallest doc_id and the fingerprint that names its group."""
    nodes = stored(spark, own.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    roots = connected(spark, links(spark, nodes.select("fp"), bits))
    return nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def near_duplicates(spark: SparkSession, docs: DataFrame, words: int = SHINGLE_WORDS, bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) for every row of `docs` (doc_id, text, others ignored).

    component_id is the smallest doc_id reachable by links, the row's own included. Null or empty texts
    have fingerprint 0 and are linked like any other; repeated rows are copies of each other; a null
    doc_id is never a component's id unless all its rows have none. An empty table gives no rows."""
    own = stored(spark, fingerprints(docs, words), "fingerprints")
    rooted = _rooted(spark, own, bits)
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return own.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(spark: SparkSession, docs: DataFrame, words: int = SHINGLE_WORDS, bits: int = MAX_BITS) -> DataFrame:
    """One row of `docs` per group: that with the smallest doc_id, rows without one last; all columns stay.
    Rows that share a doc_id, or have none, are judged by their texts: those of several groups stay in each, of
    several in one group the text with the smallest hash does. Of rows repeated exactly one stays, and of rows that
    differ in other columns only, any one."""
    copy = F.xxhash64("text", F.isnull("text"))  # tells texts under one doc_id apart
    own = stored(spark, fingerprints(docs, words, copy), "fingerprints")
    rooted = _rooted(spark, own, bits).select("fp", "root")
    by_fp = own.groupBy("fp").agg(F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "copy")).alias("least"))
    stay = by_fp.join(rooted, "fp").groupBy("root").agg(F.min("least").alias("least")).select(
        F.col("least.doc_id").alias("_doc_id"), F.col("least.copy").alias("_least"))
    # The caller's columns stay together, so that none of their names can clash.
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("doc_id").cast("long").alias("id"), copy.alias("copy"))
    stay = stay.select(F.col("_doc_id").alias("stay_id"), F.col("_least").alias("stay_copy"))
    kept = whole.join(stay, F.col("id").eqNullSafe(F.col("stay_id")) & (F.col("copy") == F.col("stay_copy")), "left_semi")
    return kept.dropDuplicates(["id", "copy"]).select("doc.*")
