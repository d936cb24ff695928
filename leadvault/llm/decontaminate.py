"""Benchmark decontamination by FM-indexes.

Documents are dealt into shards, and each shard gets an FM-index over its words (`fm_index`), stored as one
row. The windows of all benchmark items are searched backwards in every shard, their occurrences located by sampled
suffix positions, and the words they cover merged into removal spans. The index knows nothing of the benchmark: another
benchmark can be searched in the stored table."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadvault.llm.common import stored
from leadvault.llm.fm_index import LOCATE_ROWS, FmIndex
from leadvault.llm.term_shards import (SHARD_TERMS, Vocabulary, in_blocks, meet, numbered, rows_of, terms, unpacked)

#: Consecutive words of an item that make a window.
WINDOW = 10
#: Windows that are searched together.
BLOCK_WINDOWS = 1 << 16

_SHARDS = "row array<long>, doc_id array<long>, first array<long>, size array<long>, n_words array<long>, vocabulary binary, fm binary"
_SPAN = pa.struct([("from", pa.int64()), ("to", pa.int64())])
_PIECES = "row long, doc_id long, n_words long, spans array<struct<from: long, to: long>>, windows array<binary>"


def _parts(total: int, longest: int, shard_terms: int) -> Iterator[tuple[int, int]]:
    """(first, end) of the parts of a text of `total` words. Parts share so many words that every window lies whole in one."""
    first = 0
    while True:
        end = min(total, first + shard_terms)
        yield first, end
        if end == total:
            return
        first = end - longest + 1


def index(docs: DataFrame, longest: int = WINDOW, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """One row per shard of `docs` (doc_id, text, others ignored): its documents, or parts of very long ones, its
    vocabulary and its FM-index, in which phrases of up to `longest` words can be searched."""
    if shard_terms < 2 * longest:
        raise ValueError("a shard must hold two phrases")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words, size = [], Vocabulary(), 0

        def shard() -> pa.RecordBatch:
            symbols = np.concatenate([np.append(part + 1, 0) for *_, part in held])
            docs_of = [[[h[k] for h in held]] for k in range(3)]
            lists = [pa.array(c, pa.list_(pa.int64())) for c in (*docs_of, [[len(h[4]) for h in held]], [[h[3] for h in held]])]
            blobs = [pa.array([b], pa.binary()) for b in (words.packed(), FmIndex.build(symbols).packed())]
            return pa.RecordBatch.from_arrays([*lists, *blobs], ["row", "doc_id", "first", "size", "n_words", "vocabulary", "fm"])

        for row, doc, text in rows_of(batches):
            found = terms(text)
            for first, end in _parts(len(found), longest, shard_terms):
                if held and size + end - first + 1 > shard_terms:
                    yield shard()
                    held, words, size = [], Vocabulary(), 0
                held.append((row, doc, first, len(found), words.numbers(found[first:end])))
                size += end - first + 1
        if held:
            yield shard()

    return numbered(docs).mapInArrow(run, _SHARDS)


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(window, item_id), each once: every `window` consecutive words of an item, or all of them where it has fewer,
    joined by spaces. Items under one id are one item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for item, text in rows_of([batch]):
                words = terms(text)
                if words:
                    found += [(b" ".join(words[k:k + window]), item) for k in range(max(len(words) - window, 0) + 1)]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.string())],
                                             ["window", "item_id"])

    return benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("binary")).mapInArrow(
        run, "window binary, item_id string").distinct()


class _Block:
    """The windows of a block as rows of word numbers, the words numbered in order of first sight."""

    def __init__(self, block: list[bytes]):
        split, self.words = [w.split() for w in block], Vocabulary()
        self.windows, self.lengths = block, np.array([len(w) for w in split])
        self.numbers = np.zeros((len(block), int(self.lengths.max(initial=1))), np.int64)
        for k, words in enumerate(split):
            self.numbers[k, self.numbers.shape[1] - len(words):] = self.words.numbers(words) + 1

    def symbols(self, vocabulary: dict[bytes, int]) -> np.ndarray:
        known = np.array([0, *(vocabulary.get(w, -2) + 1 for w in self.words)])
        return known[self.numbers]


def _occurrences(fm: FmIndex, block: _Block, vocabulary: dict[bytes, int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text position, number of the window in the block) of all occurrences, a bounded number at a time."""
    low, high = fm.search(block.symbols(vocabulary))
    hit = np.flatnonzero(high > low)
    if not len(hit):
        return
    ends = np.cumsum(high[hit] - low[hit])
    for at in range(0, int(ends[-1]), LOCATE_ROWS):
        k = np.arange(at, min(at + LOCATE_ROWS, int(ends[-1])))
        of = np.searchsorted(ends, k, side="right")
        yield fm.locate(high[hit[of]] - (ends[of] - k)), hit[of]


def merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges united where they overlap or touch, in order."""
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    opens = np.flatnonzero(np.concatenate([[True], begin[1:] > end[:-1]]))
    return begin[opens], end[np.append(opens[1:], len(end)) - 1]


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document (part) of a shard and block: its spans, in words of the document, and the windows that occur in it."""
    number, block = None, None
    for rows, docs, firsts, sizes, totals, vocabulary, packed, at, texts in rows_of(batches):
        if at != number:
            number, block = at, _Block(texts)
        starts = np.concatenate([[0], np.cumsum(np.array(sizes) + 1)])
        spans: list = [None] * len(rows)
        seen: list = [None] * len(rows)
        places = list(_occurrences(FmIndex.unpacked(packed), block, unpacked(vocabulary)))
        if places:
            position, which = (np.concatenate(c) for c in zip(*places))
            begin, end = merged(position, position + block.lengths[which])  # spans never reach beyond a document's end mark
            for k, a, b in zip((np.searchsorted(starts, begin, side="right") - 1).tolist(), begin.tolist(), end.tolist()):
                shift = firsts[k] - int(starts[k])
                spans[k] = [*(spans[k] or []), {"from": a + shift, "to": b + shift}]
            told = np.unique((np.searchsorted(starts, position, side="right") - 1) * len(block.windows) + which)
            for k, w in zip(*(x.tolist() for x in np.divmod(told, len(block.windows)))):
                seen[k] = [*(seen[k] or []), block.windows[w]]
        for at_ in range(0, len(rows), 10_000):
            part = slice(at_, at_ + 10_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (rows[part], docs[part], totals[part])]
                + [pa.array(spans[part], pa.list_(_SPAN)), pa.array(seen[part], pa.list_(pa.binary()))],
                ["row", "doc_id", "n_words", "spans", "windows"])


def search(spark: SparkSession, shards: DataFrame, found: DataFrame, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """(row, doc_id, n_words, spans, items): every document of the stored index `shards` against the stored `windows`
    `found`. Spans are ranges of words in order, apart from each other; items are sorted as strings."""
    distinct, count = in_blocks(found.select("window").distinct(), block_windows, "window")
    blocks = distinct.groupBy("block").agg(F.collect_list("window").alias("texts"))
    pieces = stored(spark, meet(shards, blocks, count).select(
        "row", "doc_id", "first", "size", "n_words", "vocabulary", "fm", "block", "texts").mapInArrow(_found, _PIECES), "pieces")
    hits = pieces.where("windows is not null").select("row", F.explode("windows").alias("window"))
    items = hits.join(found, "window").where("item_id is not null").select("row", "item_id").distinct().groupBy("row").agg(
        F.array_sort(F.collect_list("item_id")).alias("items"))
    # The spans of a document are no more than its words.
    spans = pieces.where("spans is not null").select("row", F.explode("spans").alias("span")).groupBy("row").agg(
        F.array_sort(F.collect_list("span")).alias("spans"))
    joined = F.aggregate(
        "spans", F.array().cast("array<struct<from: long, to: long>>"),
        lambda done, s: F.when((F.size(done) > 0) & (F.element_at(done, -1)["to"] >= s["from"]),
                               F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                                   F.element_at(done, -1)["from"].alias("from"),
                                   F.greatest(F.element_at(done, -1)["to"], s["to"]).alias("to")))))
        .otherwise(F.concat(done, F.array(s))))
    whole = pieces.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"))
    return whole.join(spans.withColumn("spans", joined), "row", "left").join(items, "row", "left").select(
        "row", "doc_id", "n_words", F.coalesce("spans", F.array().cast("array<struct<from: long, to: long>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  shard_terms: int = SHARD_TERMS, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """`search` for all rows of `docs` (doc_id, text, others ignored) and `benchmark` (item_id, text, others ignored).

    Null and empty texts have no words: such items find nothing, such documents have no span. Items of fewer than
    `window` words are one window. Rows of `docs` are documents of their own, whatever their ids; rows of `benchmark`
    under one id are one item, repeated rows count once, and an item without an id covers words but is not listed.
    Texts of more than a shard are indexed in overlapping parts. An empty table of documents gives no rows, an empty
    benchmark no spans."""
    shards = stored(spark, index(docs, window, shard_terms), "fm_shards")
    found = stored(spark, windows(benchmark, window), "windows")
    if found.isEmpty():
        return shards.select(F.explode(F.arrays_zip("row", "doc_id", "first", "n_words")).alias("d")).where("d.first = 0").select(
            "d.row", "d.doc_id", "d.n_words", F.array().cast("array<struct<from: long, to: long>>").alias("spans"),
            F.array().cast("array<string>").alias("items"))
    return search(spark, shards, found, block_windows)


_TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def without(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """The text without the words of `spans` (ranges of words, in order) and what stands between them."""
    if not text or not spans:
        return text
    places, parts, at = [m.span() for m in _TERM.finditer(text)], [], 0
    for first, end in spans:
        parts.append(text[at:places[first][0]])
        at = places[end - 1][1]
    return "".join([*parts, text[at:]])
