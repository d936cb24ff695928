"""Packing tokenised documents into sequences: bounded-space online best-fit.

A fixed number of open bins is kept in a bitset keyed by free space: bit f is set while some open bin has f
tokens free. A piece goes where the least space is left over; where it fits nowhere a bin is opened, and
if that is one too many the fullest closes first. Pieces are packed in groups of a bounded number of them."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadvault.llm.common import stored

SEQUENCE = 4096
OPEN_BINS = 1024
#: Sequences' worth of tokens, and at most so many pieces, that are packed together.
GROUP_SEQUENCES, GROUP_ROWS = 4096, 500_000
END_ID = 1
#: Words whose ids a worker remembers; when so many are known it starts anew.
KNOWN_WORDS = 800_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class _Ids(dict):
    """word (bytes) -> its ids as little-endian unsigned 32-bit numbers, tokenised when first asked for. `special`
    finds the names of the tokenizer's special tokens, `special_ids` has their ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Words hold no such name but in another case, and come here in lower case.
        self.tokenizer.encode_special_tokens = True
        named = {t.content: k for k, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special_ids = {name: array("I", [k]).tobytes() for name, k in named.items()}
        longest = sorted(named, key=len, reverse=True)
        self.special = re.compile(f"({'|'.join(map(re.escape, longest))})" if longest else "((?!))")

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        ids = self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
        self[word] = found = array("I", ids).tobytes()
        return found


_known = lru_cache(maxsize=2)(_Ids)
_END = np.array([END_ID], "<u4").tobytes()


def token_ids(text: str | None, path: str) -> np.ndarray:
    """The ids (uint32) that the tokenizer gives the text with add_special_tokens=False, then END_ID; a null text
    has END_ID only. The names of special tokens in a text, in their exact case, are those tokens. Between them the
    vocabulary lower-cases, drops white space and joins nothing across it, so the ids are those of the words in a
    row; words are cut at ASCII spaces, and other spaces stay inside them."""
    known, out = _known(path), []
    for k, part in enumerate(known.special.split(text or "")):
        if k % 2:
            out.append(known.special_ids[part])
        else:
            out += map(known.__getitem__, part.encode("utf-8", "replace").lower().split())
    return np.frombuffer(b"".join([*out, _END]), "<u4")


def pieces(docs: DataFrame, path: str, sequence: int = SEQUENCE) -> DataFrame:
    """One row per piece of `docs` (doc_id, text, others ignored): documents of more than `sequence` tokens are
    cut after every `sequence` tokens, others are one piece. `ids_crc32` is that of the ids as little-endian
    unsigned 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0), batch.column(1)):
                tokens = token_ids(text.as_py(), path)
                for piece, start in enumerate(range(0, len(tokens), sequence)):
                    part = tokens[start:start + sequence]
                    rows.append((doc.as_py(), piece, start, len(part), zlib.crc32(part)))
            names, types = ["doc_id", "piece", "start", "length", "ids_crc32"], [pa.int64(), pa.int32()] + [pa.int64()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, types)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


class BestFit:
    """Open bins by free space. `place` returns the bin's number and the offset in it; pieces under one `key` never
    share a bin."""

    def __init__(self, sequence: int, open_bins: int):
        self.sequence, self.open_bins = sequence, open_bins
        self.free: dict[int, list[int]] = {}  # free space -> bins, most recent last
        self.keys: dict[int, set] = {}  # open bin -> keys in it
        self.bits, self.count, self.next = 0, 0, 0

    def _take(self, free: int, place: int = -1) -> int:
        bins = self.free[free]
        number = bins.pop(place)
        if not bins:
            del self.free[free]
            self.bits &= ~(1 << free)
        self.count -= 1
        return number

    def _put(self, number: int, free: int) -> None:
        if free:  # a full bin closes by itself
            self.free.setdefault(free, []).append(number)
            self.bits |= 1 << free
            self.count += 1
        else:
            self.keys.pop(number, None)

    def _fitting(self, length: int, key) -> tuple[int, int] | None:
        """(free space, place among the bins that have it) of the bin with least space left over that lacks the key."""
        free, fitting = length, self.bits >> length
        while fitting:
            step = (fitting & -fitting).bit_length() - 1
            free, fitting = free + step, fitting >> step
            for place in reversed(range(len(self.free[free]))):
                if key is None or key not in self.keys[self.free[free][place]]:
                    return free, place
            free, fitting = free + 1, fitting >> 1
        return None

    def place(self, length: int, key=None) -> tuple[int, int]:
        found = self._fitting(length, key)
        if found:
            free = found[0]
            number = self._take(*found)
        else:
            if self.count >= self.open_bins:
                self.keys.pop(self._take((self.bits & -self.bits).bit_length() - 1), None)  # the fullest
            free, number, self.next = self.sequence, self.next, self.next + 1
        if key is not None:
            self.keys.setdefault(number, set()).add(key)
        self._put(number, free - length)
        return number, self.sequence - free


def pack(spark: SparkSession, found: DataFrame, sequence: int = SEQUENCE, open_bins: int = OPEN_BINS, apart: bool = False,
         group_sequences: int = GROUP_SEQUENCES, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Adds sequence_id and offset to the rows of `pieces`.

    Pieces are stored and dealt by hash into groups, each packed by itself. How many groups there are follows from the tokens, so a group
    has thousands of sequences to fill whatever the number of tasks, and leaves few of them part-filled. `apart`:
    copies of a piece under one doc_id never share a sequence."""
    columns = [c.split()[0] for c in PIECES.split(", ")]
    found = stored(spark, found.withColumn("row", F.monotonically_increasing_id()), "pieces")
    tokens, rows = found.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count("*")).first()
    groups = max(1, round(tokens / (sequence * group_sequences)), rows // group_rows)
    order = F.xxhash64("doc_id", "piece", "start", "length", "ids_crc32", "row")
    dealt = found.withColumn("order", order).withColumn("deal", F.pmod("order", F.lit(groups)))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["order", "row"], ignore_index=True)
        bins, first = BestFit(sequence, open_bins), int(part["deal"].iloc[0]) << 40
        keys = zip(part["doc_id"].astype(object).where(part["doc_id"].notna(), None), part["piece"], part["ids_crc32"]) if apart else [None] * len(part)
        placed = [bins.place(n, key) for n, key in zip(part["length"].tolist(), keys)]
        return part[columns].assign(sequence_id=[first + p[0] for p in placed], offset=[p[1] for p in placed])

    return dealt.groupBy("deal").applyInPandas(run, PIECES + ", sequence_id long, offset long")


def pack_documents(spark: SparkSession, docs: DataFrame, path: str, sequence: int = SEQUENCE, open_bins: int = OPEN_BINS,
                   apart: bool = False) -> DataFrame:
    """All of `docs` in sequences of at most `sequence` tokens, one row per piece. Null and empty texts are one
    token; repeated rows are packed each, and with `apart` never two of them into one sequence; null ids stay null; an empty
    table gives no rows."""
    return pack(spark, pieces(docs, path, sequence), sequence, open_bins, apart)
