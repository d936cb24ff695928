"""Terms of texts, and shards of documents: what the lexical index operators share.

A term is a maximal run of digits, ASCII letters and characters beyond ASCII; only A-Z are lower-cased. Whole
documents are dealt into shards of a bounded number of terms, in the order a task reads them, and every shard has
a vocabulary of its own, so nothing that grows with the corpus is shared between tasks."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Terms (a document counts as one more) of a shard.
SHARD_TERMS = 1 << 20


def _term_byte(c: int) -> int:
    if 65 <= c <= 90:
        return c + 32
    return c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32


_TERM_BYTES = bytes(map(_term_byte, range(256)))


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8; null has none."""
    return text.translate(_TERM_BYTES).split() if text else []


class Vocabulary(defaultdict):
    """term -> number, in order of first sight."""

    def __init__(self):
        super().__init__()
        self.default_factory = self.__len__

    def numbers(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, found), np.int32, len(found))

    def packed(self) -> bytes:
        return b" ".join(self)


def unpacked(packed: bytes) -> dict[bytes, int]:
    """The dictionary of `Vocabulary.packed`."""
    return {term: k for k, term in enumerate(packed.split())}


def numbered(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text as bytes): row tells repeated rows and ids apart."""
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("binary").alias("text"))


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows as tuples, values turned into Python's one at a time, so that only one long value is held."""
    for batch in batches:
        for row in zip(*batch.columns):
            yield tuple(value.as_py() for value in row)


def in_blocks(df: DataFrame, size: int, key: str) -> tuple[DataFrame, int]:
    """`df` with a column `block`, and the number of blocks: rows of distinct `key` are dealt by hash into blocks of
    about `size` rows."""
    blocks = df.count() // size + 1
    return df.withColumn("block", F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")), blocks


def meet(shards: DataFrame, blocks: DataFrame, count: int) -> DataFrame:
    """Every shard beside every one of the `count` blocks: the stated query set against all rows, in blocks. Spark
    looks at the size of the blocks and broadcasts them or shuffles both."""
    dealt = shards.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    return dealt.join(blocks, "block")
