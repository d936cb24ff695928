"""Exact top-k inner products by MaxScore.

Dimensions are the terms. Inside a shard a dimension's contribution to a query is made non-negative by
counting it from its least value, which bounds it by |q| x range. A query's terms, sorted by bound, are split:
what the non-essential ones can add together is below the score needed so far, so no vector gets into
the result by them alone. The essential postings are traversed for all vectors of the shard; the others
are probed, term by term, only for the vectors that are still competitive. Shard results are merged.

Query block x shard is one group: both have bounded numbers of rows, and blocks of queries meet all shards."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadvault.llm.common import stored

TOP = 20
SHARD_ROWS, QUERY_ROWS = 16_384, 4_096
_EXACT = float(1 << 53)


def weights(vectors: DataFrame, scale: float = 64.0) -> DataFrame:
    """(row, vec_id, weights): floor(scale * x) of each component x as double; `row` tells rows apart. Rows without id or
    vector, and vectors that hold null or non-finite components, take no part. To be stored, so that rows keep their number."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("long"))
    return vectors.where("vec_id is not null and embedding is not null").where(finite).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"), whole.alias("weights"))


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    """dimensions x rows; components that a shorter vector lacks are 0."""
    out = np.zeros((width, len(rows)), np.int64)
    for k, row in enumerate(rows):
        out[:len(row), k] = row
    return out


def _top(scores: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Indexes of the best `top`, larger scores first, ties to smaller ids."""
    if len(scores) > top:
        least = np.partition(scores, len(scores) - top)[len(scores) - top]
        kept = np.flatnonzero(scores >= least)
    else:
        kept = np.arange(len(scores))
    return kept[np.lexsort((ids[kept], -scores[kept]))][:top]


#: The share of the score needed that the terms left to probing can add: traversing a term together costs less than probing it.
PROBED = 1 / 4
#: Queries whose essential terms are traversed together.
TOGETHER = 128


def search(shard: np.ndarray, ids: np.ndarray, rows: np.ndarray, low: np.ndarray, high: np.ndarray, asked: np.ndarray, own: np.ndarray,
           top: int):
    """Per query (a column of `asked`) the (indexes, scores) of the best `top` columns of `shard` (terms x vectors, with their
    least and greatest values per term), the query's own row left out. The essential terms of all these queries are
    traversed at once, the others probed query by query."""
    bounds = np.abs(asked) * (high - low)[:, None]
    order = np.argsort(-bounds, axis=0, kind="stable")
    sorted_bounds = np.take_along_axis(bounds, order, 0)
    rest = np.vstack([np.cumsum(sorted_bounds[::-1], axis=0)[::-1], np.zeros((1, asked.shape[1]), bounds.dtype)])  # what terms from here on can add
    base = (np.where(asked > 0, low[:, None], high[:, None]) * asked).sum(axis=0)  # the score of a vector with least contributions
    some, width = min(4 * top, len(ids)), len(asked)
    first = asked.T @ shard[:, :some] - base[:, None]
    essential, needed = np.ones(len(own), np.int64), np.full(len(own), -1, bounds.dtype)
    for k in range(len(own)):
        scores = first[k][rows[:some] != own[k]]
        terms = int((bounds[:, k] > 0).sum())
        if len(scores) >= top:
            needed[k] = np.partition(scores, len(scores) - top)[len(scores) - top]
            terms = min(terms, int(np.searchsorted(-rest[:, k], -needed[k] * PROBED, side="right")))
        essential[k] = min(max(terms, 1), width)
    taken = np.zeros(asked.shape, asked.dtype)
    np.put_along_axis(taken, order, np.where(np.arange(width)[:, None] < essential, np.take_along_axis(asked, order, 0), 0), 0)
    partial = taken.T @ shard - (np.where(taken > 0, low[:, None], high[:, None]) * taken).sum(axis=0)[:, None]
    for k in range(len(own)):
        alive = np.flatnonzero(partial[k] + rest[essential[k], k] >= needed[k])
        alive = alive[rows[alive] != own[k]]
        scores = partial[k][alive]
        for at in range(essential[k], width):
            if not rest[at, k]:
                break
            if len(scores) > top:
                needed[k] = max(needed[k], np.partition(scores, len(scores) - top)[len(scores) - top])
            stay = scores + rest[at, k] >= needed[k]
            term, alive, scores = order[at, k], alive[stay], scores[stay]
            query = asked[term, k]
            scores = scores + query * (shard[term, alive] - (low[term] if query > 0 else high[term]))
        best = _top(scores, ids[alive], top)
        yield alive[best], scores[best] + base[k]


def _block(queries: pd.DataFrame, shard: pd.DataFrame, top: int) -> pd.DataFrame:
    if not len(queries) or not len(shard):
        return pd.DataFrame({"query": [], "query_id": [], "vec_id": [], "score": []}).astype("int64")
    width = int(max(queries["weights"].map(len).max(), shard["weights"].map(len).max()))
    vectors, asked = _matrix(shard["weights"], width), _matrix(queries["weights"], width)
    ids, rows, out = shard["vec_id"].to_numpy(), shard["row"].to_numpy(), []
    # Doubles add up exactly up to 2**53; beyond that integers are used.
    reach = sum(float(a) * float(b) for a, b in zip(np.abs(vectors.astype(float)).max(axis=1, initial=0),
                                                    np.abs(asked.astype(float)).max(axis=1, initial=0)))
    if reach * 4 < _EXACT:
        vectors, asked = vectors.astype(float), asked.astype(float)
    low, high = vectors.min(axis=1), vectors.max(axis=1)
    owns, names = queries["row"].to_numpy(), queries["vec_id"].to_numpy()
    for at in range(0, len(owns), TOGETHER):
        found = search(vectors, ids, rows, low, high, asked[:, at:at + TOGETHER], owns[at:at + TOGETHER], top)
        for own, query, (best, scores) in zip(owns[at:], names[at:], found):
            out.append(pd.DataFrame({"query": own, "query_id": query, "vec_id": ids[best], "score": scores.astype("int64")}))
    return pd.concat(out)


def top_k(spark: SparkSession, queries: DataFrame, vectors: DataFrame, top: int = TOP, shard_rows: int = SHARD_ROWS,
          query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each of `queries` the `top` largest inner products with `vectors` (both
    row, vec_id, weights, as stored), the query's own row left out, ties to the smaller vec_id. Fewer vectors: all.
    Vectors of unequal length are filled up with 0. Every row counts: repeated rows and rows under one id are candidates of each other,
    and queries of their own. Scores beyond 64 bits are not defined."""
    shards, blocks = vectors.count() // shard_rows + 1, queries.count() // query_rows + 1
    deal = F.xxhash64("row")
    asked = queries.withColumn("block", F.pmod(deal, F.lit(blocks))).withColumn(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    # Columns of their own: where both sides of the cogroup are of one table, Spark mixes up what they share.
    own = vectors.select(*[F.col(c).alias(c) for c in ("row", "vec_id", "weights")])
    held = own.withColumn("shard", F.pmod(deal, F.lit(shards))).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    found = asked.groupBy("shard", "block").cogroup(held.groupBy("shard", "block")).applyInPandas(
        lambda q, v: _block(q, v, top), "query long, query_id long, vec_id long, score long")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def nearest(spark: SparkSession, embeddings: DataFrame, every: int, top: int = TOP) -> DataFrame:
    """`top_k` of the rows of `embeddings` (vec_id, embedding, others ignored) whose id is divisible by `every`,
    against all rows."""
    vectors = stored(spark, weights(embeddings), "weights")
    return top_k(spark, vectors.where(F.col("vec_id") % every == 0), vectors, top)
