"""Exact ranked lexical search over norm buckets, after LEMP.

A document is a vector of impacts, one per term; a query is a vector of term weights; the score is their inner
product. Inside a shard the impact vectors are ordered by length (each term scaled by the root of its weight, on both
sides, which leaves the product as it is) and cut into buckets. A query goes through the buckets from long to
short: once its own length times the bucket's greatest cannot reach the score needed (Cauchy-Schwarz), all that
follow are left out. Inside a bucket only the query's heaviest coordinates are read, as many as are needed to make
the rest too short; what a vector has on them, plus what its remaining length allows, bounds its score.
Vectors that survive are scored again in integers. Shard results are merged."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadvault.llm.common import stored
from leadvault.llm.term_shards import SHARD_TERMS, Vocabulary, in_blocks, meet, numbered, rows_of, terms, unpacked

TOP = 20
#: Terms whose document counts are looked up together, and queries that are searched together.
BLOCK_TERMS, BLOCK_QUERIES = 1 << 16, 1 << 8
#: Vectors of the first bucket; each may hold twice as many as the one before, up to the second number. A bucket
#: ends earlier where lengths fall below this part of its greatest.
FIRST_BUCKET, LAST_BUCKET, SHORTEST = 64, 4096, 0.7
#: Bounds are sums of doubles; this much room makes up for their rounding.
ROOM = 1 + 1e-9

_SHARDS = ("doc_id array<long>, docs long, length long, vocabulary binary, df binary, n binary, ends binary, term binary, tf binary")


def index(docs: DataFrame, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """One row per shard of `docs` (doc_id, text, others ignored): its documents that have terms, how many they are and
    their terms with repeats, the vocabulary with document counts, and per document n and its terms with tf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words, size = [], Vocabulary(), 0

        def shard() -> pa.RecordBatch:
            ids, n, term, tf = zip(*held)
            ends, term, n = np.cumsum([len(t) for t in term]), np.concatenate(term), np.array(n)
            blobs = [words.packed(), np.bincount(term).astype("<u4"), n.astype("<i8"), ends.astype("<i8"), term.astype("<u4"),
                     np.concatenate(tf).astype("<u4")]
            return pa.RecordBatch.from_arrays(
                [pa.array([ids], pa.list_(pa.int64())), pa.array([len(ids)], pa.int64()), pa.array([int(n.sum())], pa.int64())]
                + [pa.array([b if isinstance(b, bytes) else b.tobytes()], pa.binary()) for b in blobs],
                ["doc_id", "docs", "length", "vocabulary", "df", "n", "ends", "term", "tf"])

        for _, doc, text in rows_of(batches):
            found = terms(text)
            if not found:
                continue
            if held and size + len(found) > shard_terms:
                yield shard()
                held, words, size = [], Vocabulary(), 0
            term, tf = np.unique(words.numbers(found), return_counts=True)
            held.append((doc, len(found), term, tf))
            size += len(found)
        if held:
            yield shard()

    return numbered(docs).mapInArrow(run, _SHARDS)


def query_terms(items: DataFrame) -> DataFrame:
    """(query, item_id, term, times) of `items` (item_id, text, others ignored): one query per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(query, item, term, times) for query, item, text in rows_of([batch]) for term, times in Counter(terms(text)).items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*found) if found else [()] * 4, (pa.int64(), pa.int64(), pa.binary(), pa.int64()))],
                ["query", "item_id", "term", "times"])

    rows = items.select(F.monotonically_increasing_id().alias("query"), F.col("item_id").cast("long"), F.col("text").cast("binary"))
    return rows.mapInArrow(run, "query long, item_id long, term binary, times long")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for vocabulary, df, wanted in rows_of(batches):
        known, counts = unpacked(vocabulary), np.frombuffer(df, "<u4")
        found = [(term, int(counts[known[term]])) for term in wanted if term in known]
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.int64())],
                                         ["term", "df"])


def weighted(shards: DataFrame, queries: DataFrame, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """`queries` (query_terms) with each term's weight: floor(1000 * ln((2 * N + 2) / (2 * df + 1))), and the totals N and L as n_docs and n_terms. Terms
    that no document has are left out, and so are weights of 0, which add nothing."""
    distinct, count = in_blocks(queries.select("term").distinct(), block_terms, "term")
    blocks = distinct.groupBy("block").agg(F.collect_list("term").alias("wanted"))
    df = meet(shards.select("vocabulary", "df"), blocks, count).select("vocabulary", "df", "wanted").mapInArrow(
        _counted, "term binary, df long").groupBy("term").agg(F.sum("df").alias("df"))
    totals = shards.agg(F.sum("docs").alias("n_docs"), F.sum("length").alias("n_terms"))
    n, length = totals.select("n_docs").scalar(), totals.select("n_terms").scalar()
    weight = F.floor(1000 * F.log((2 * F.col("n_docs") + 2) / (2 * F.col("df") + 1))).cast("long")
    return queries.join(df, "term").withColumns({"n_docs": n, "n_terms": length}).withColumn("weight", weight).where("weight > 0")


class _Queries:
    """A block of queries over one numbering of their terms."""

    def __init__(self, block: list[dict]):
        self.words, weight = Vocabulary(), {}
        self.id, self.item, self.term, self.times = [], [], [], []
        for q in block:
            self.id.append(q["query"])
            self.item.append(q["item_id"])
            self.term.append(self.words.numbers([t["term"] for t in q["terms"]]))
            self.times.append(np.array([t["times"] for t in q["terms"]], np.int64))
            weight |= {t["term"]: t["weight"] for t in q["terms"]}
        self.weight = np.array([weight[w] for w in self.words], np.int64)


class _Bucket:
    """Impact vectors in order of length: by term for the bounds, by vector for the scores."""

    def __init__(self, number: np.ndarray, ends: np.ndarray, term: np.ndarray, impact: np.ndarray, scaled: np.ndarray, squared: np.ndarray,
                 count: int):
        self.number, self.squared = number, squared
        self.length = float(np.sqrt(squared[0]))
        self.begins, self.ends = ends - np.diff(ends, prepend=0), ends
        self.term, self.impact = term, impact
        order = np.argsort(term, kind="stable")
        vector = np.repeat(np.arange(len(number)), np.diff(ends, prepend=0))
        self.vector, self.scaled = vector[order], scaled[order]
        self.first = np.searchsorted(term[order], np.arange(count + 1))

    def candidates(self, coordinates: np.ndarray, values: np.ndarray, rest: float, needed: int) -> np.ndarray:
        """Vectors that may score `needed`: their product over `coordinates` plus `rest`, the length of the
        query's other coordinates, times their own remaining length."""
        begin = self.first[coordinates]
        sizes = self.first[coordinates + 1] - begin
        at = _ranges(begin, sizes)
        vector, value = self.vector[at], self.scaled[at]
        product = np.bincount(vector, value * np.repeat(values, sizes), len(self.number))
        seen = np.bincount(vector, value * value, len(self.number))
        bound = product + rest * np.sqrt(np.maximum(self.squared - seen, 0) + self.squared * 1e-12)
        return np.flatnonzero((seen > 0) & (bound * ROOM >= needed))

    def scores(self, vectors: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Exact scores; `weight` has the query's whole weight of every term."""
        sizes = self.ends[vectors] - self.begins[vectors]
        at = _ranges(self.begins[vectors], sizes)
        added = weight[self.term[at]] * self.impact[at]
        return np.add.reduceat(added, np.cumsum(sizes) - sizes)


def _ranges(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... for every range, one after the other."""
    return np.arange(int(sizes.sum())) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)


def buckets(known: dict[bytes, int], block: _Queries, n: np.ndarray, ends: np.ndarray, term: np.ndarray, tf: np.ndarray, docs: int,
            length: int) -> Iterator[_Bucket]:
    """The vectors of a shard over the block's terms, longest first; those without such a term are left out."""
    place = np.full(len(known), -1, np.int64)
    for k, word in enumerate(block.words):
        if (at := known.get(word)) is not None:
            place[at] = k
    of = place[term]
    doc = np.repeat(np.arange(len(n)), np.diff(ends, prepend=0))[of >= 0]
    tf, of = tf[of >= 0].astype(np.int64), of[of >= 0]
    m = 100 - 25 + (25 * n * docs) // length
    impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m[doc])
    scaled = impact * np.sqrt(block.weight[of].astype(float))
    squared = np.bincount(doc, scaled * scaled, len(n))
    sizes = np.bincount(doc, minlength=len(n))
    order = np.argsort(-squared, kind="stable")[:np.count_nonzero(squared)]
    begins = np.cumsum(sizes) - sizes
    at, limit = 0, FIRST_BUCKET
    while at < len(order):
        least = squared[order[at]] * SHORTEST * SHORTEST
        end = max(int(np.searchsorted(-squared[order], -least, side="right")), at + FIRST_BUCKET)
        end = min(end, at + limit, len(order))
        some = order[at:end]
        take = _ranges(begins[some], sizes[some])
        yield _Bucket(some, np.cumsum(sizes[some]), of[take], impact[take], scaled[take], squared[some], len(block.words))
        at, limit = end, min(2 * limit, LAST_BUCKET)


def best(block: _Queries, found: Iterator[_Bucket], ids: np.ndarray, top: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(documents, scores) of the `top` best per query of the block, equal scores by smaller id."""
    root = np.sqrt(block.weight.astype(float))
    weight = np.zeros(len(block.words), np.int64)
    queries = []
    for term, times in zip(block.term, block.times):
        value = times * root[term]
        order = np.argsort(-value, kind="stable")
        rest = np.sqrt(np.append(np.cumsum((value[order] ** 2)[::-1])[::-1], 0))
        queries.append((term[order], value[order], rest, times[order] * block.weight[term[order]]))
    kept = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in queries]
    open_ = set(range(len(queries)))
    for bucket in found:
        for q in list(open_):
            term, value, rest, whole = queries[q]
            docs, scores = kept[q]
            needed = int(scores[top - 1]) if len(scores) >= top else 1
            if rest[0] * bucket.length * ROOM < needed:  # and shorter vectors reach it even less
                open_.discard(q)
                continue
            focus = int(np.argmax(rest * bucket.length * ROOM < needed))
            alive = bucket.candidates(term[:focus], value[:focus], rest[focus], needed)
            if not len(alive):
                continue
            weight[term] = whole
            exact = bucket.scores(alive, weight)
            weight[term] = 0
            good = exact >= needed
            docs, scores = np.append(docs, bucket.number[alive[good]]), np.append(scores, exact[good])
            order = np.lexsort((ids[docs], -scores))[:top]
            kept[q] = docs[order], scores[order]
        if not open_:
            break
    return kept


def top_k(spark: SparkSession, shards: DataFrame, queries: DataFrame, top: int = TOP, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(item_id, rank, doc_id, score): for each of `queries` (weighted) the `top` best documents of the stored index."""
    last = np.iinfo(np.int64).max

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = None, None
        for at, asked, docs, length, ids, vocabulary, *blobs in rows_of(batches):
            if at != number:
                number, block = at, _Queries(asked)
            n, ends, term, tf = (np.frombuffer(b, t) for b, t in zip(blobs, ("<i8", "<i8", "<u4", "<u4")))
            order = np.array([last if k is None else k for k in ids], np.int64)
            kept = best(block, buckets(unpacked(vocabulary), block, n, ends, term, tf, docs, length), order, top)
            rows = [(block.id[q], block.item[q], ids[d], s) for q, (found, scores) in enumerate(kept) for d, s in zip(found.tolist(), scores.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [()] * 4)],
                                             ["query", "item_id", "doc_id", "score"])

    each = queries.groupBy("query", "item_id", "n_docs", "n_terms").agg(F.collect_list(F.struct("term", "times", "weight")).alias("terms"))
    dealt, count = in_blocks(each, block_queries, "query")
    blocks = dealt.groupBy("block", "n_docs", "n_terms").agg(F.collect_list(F.struct("query", "item_id", "terms")).alias("asked"))
    found = meet(shards.drop("docs", "length", "df"), blocks, count).select(
        "block", "asked", "n_docs", "n_terms", "doc_id", "vocabulary", "n", "ends", "term", "tf").mapInArrow(
        run, "query long, item_id long, doc_id long, score long")
    place = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def ranked(spark: SparkSession, docs: DataFrame, items: DataFrame, top: int = TOP, shard_terms: int = SHARD_TERMS,
           block_terms: int = BLOCK_TERMS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """`top_k` of all rows of `docs` (doc_id, text, others ignored) for each row of `items` (item_id, text, others ignored).

    Null texts have no terms. Every row of both is a document or an item of its own, whatever its id; among equal
    scores null ids come last. Items without a term of some document, and empty tables, give no rows. Scores beyond 64
    bits are not defined."""
    shards = stored(spark, index(docs, shard_terms), "term_shards")
    queries = stored(spark, query_terms(items), "queries")
    return top_k(spark, shards, stored(spark, weighted(shards, queries, block_terms), "weights"), top, block_queries)
