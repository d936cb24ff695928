"""Language identification as mixture inference.

Training: letter trigram counts per language give smoothed trigram likelihoods. Prediction: a text's words
are draws from a mixture of languages; expectation-maximisation estimates the proportions, and the set of
languages is the one with the best penalised likelihood. A text's language is the set's largest share.
`accepted` adds a background to the mixture, for words that no learned language explains.

The classifier is fitted on a bounded sample of the labelled rows (`train_docs` per language, drawn by
hash of the id); everything else reads all rows and whole texts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadvault.llm.common import by_place

UNKNOWN = "und"
#: Labelled documents per language that the model is fitted on (expected number, drawn by hash).
TRAIN_DOCS = 4000
#: Trigram counts a training task holds at a time, in languages; it passes them on where there are more.
HELD_LANGUAGES = 64
BUCKETS = 1 << 15
#: Cost of each further language, in units of log(words).
PENALTY = 4.0
ROUNDS = 6
SMOOTHING = 0.5
#: Letters handled at a time; bounds the memory of a task, not the text.
PIECE = 1 << 20


@dataclass(frozen=True)
class Model:
    languages: list[str]
    log_likelihood: np.ndarray  # buckets x languages, float32
    letters: dict[str, float]  # log frequency of each letter (and the space), whatever the language
    rare: float  # that of a letter never seen


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _points(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The code points of the lower-cased text between spaces, those of no letter as spaces; where the letters are; and
    whether each begins a word."""
    points = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    at = np.flatnonzero(letter)
    return np.where(letter, points, np.uint32(32)), at, ~letter[at - 1]


def _trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """For each letter of the lower-cased text the bucket of the trigram around it, and whether it begins a word.
    Neighbours that are no letters count as spaces."""
    points, at, begins = _points(text)
    mixed = points[at - 1] * np.uint32(0x9E3779B1) ^ points[at] * np.uint32(0x85EBCA6B) ^ points[at + 1] * np.uint32(0xC2B2AE35)
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (mixed >> np.uint32(17)).astype(np.int32), begins


def _pieces(text: str) -> Iterator[str]:
    """The text in pieces that end at a space where there is one, so that no task holds a huge text's arrays."""
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            cut = text.rfind(" ", at + 1, end)
            end = cut if cut > at else end
        yield text[at:end]
        at = end


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    """A model of the labelled rows of `docs` (doc_id, text, lang). Rows without text or lang teach nothing;
    a table without labelled rows gives a model without languages."""
    labelled = docs.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()
    languages = sorted(r["lang"] for r in sizes)
    number = {lang: k for k, lang in enumerate(languages)}
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), {}, 0.0)
    share = F.create_map(*[x for r in sizes for x in (F.lit(r["lang"]), F.lit(min(1.0, train_docs / r["n"])))])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = labelled.where(draw < share[F.col("lang")]).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of trigrams by language and bucket, and of letters by code point as language -1."""
        total, letters = {}, Counter()

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, held in [*total.items(), (-1, None)]:
                cell = np.array(sorted(letters), np.int32) if held is None else np.flatnonzero(held).astype(np.int32)
                n = np.array([letters[c] for c in cell.tolist()], np.int64) if held is None else held[cell]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cell), lang, np.int32)), pa.array(cell), pa.array(n)],
                                                 ["lang", "bucket", "n"])
            total.clear()
            letters.clear()

        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1)):
                lang = number[lang.as_py()]
                if lang not in total and len(total) >= HELD_LANGUAGES:
                    yield from rows()
                for piece in _pieces(text.as_py()):
                    total[lang] = total.get(lang, 0) + np.bincount(_trigrams(piece)[0], minlength=BUCKETS)
                    points, at, begins = _points(piece)
                    letters.update(dict(zip(*(x.tolist() for x in np.unique(points[at], return_counts=True)))))
                    letters[32] += int(begins.sum())
        yield from rows()

    counted = sample.mapInArrow(count, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counted.toArrow()  # at most languages x buckets rows
    lang, bucket, n = (found.column(c).to_numpy() for c in ("lang", "bucket", "n"))
    seen = np.zeros((BUCKETS, len(languages)), np.float32)
    of = lang >= 0
    seen[bucket[of], lang[of]] = n[of]
    whole = seen.sum(axis=0, dtype=np.float64) + SMOOTHING * BUCKETS
    letters = float(n[~of].sum()) + SMOOTHING * 0x110000
    return Model(languages, np.log((seen + SMOOTHING) / whole).astype(np.float32),
                 {chr(c): float(np.log((k + SMOOTHING) / letters)) for c, k in zip(bucket[~of], n[~of])}, float(np.log(SMOOTHING / letters)))


def _background(text: str, model: Model) -> np.ndarray:
    """The log-likelihood of the trigram around each letter where no language is behind it: an even mixture of all
    buckets being alike and of letters drawn one by one."""
    points, at, _ = _points(text)
    kinds, which = np.unique(points, return_inverse=True)
    drawn = np.array([model.letters.get(chr(c), model.rare) for c in kinds.tolist()])[which]
    return np.logaddexp(drawn[at - 1] + drawn[at] + drawn[at + 1], -np.log(BUCKETS)) - np.log(2)


def _word_likelihoods(text: str, model: Model, background: bool = False) -> np.ndarray:
    """words x languages (and the background, last): each word's likelihood, relative to the best."""
    out = []
    for piece in _pieces(text):
        buckets, begins = _trigrams(piece)
        if len(buckets):
            logs = model.log_likelihood[buckets]
            if background:
                logs = np.concatenate([logs, _background(piece, model)[:, None].astype(np.float32)], axis=1)
            logs = np.add.reduceat(logs, np.flatnonzero(begins), axis=0)
            out.append(np.exp(np.maximum(logs - logs.max(axis=1, keepdims=True), -60)))
    return np.concatenate(out) if out else np.zeros((0, len(model.languages)), np.float32)


def _em(likelihood: np.ndarray, begins: np.ndarray, document: np.ndarray, words: np.ndarray, shares: np.ndarray,
        rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions per document after `rounds`, and the log-likelihood under them. A share of 0 stays 0."""
    for _ in range(rounds):
        part = likelihood * shares[document]
        part /= np.maximum(part.sum(axis=1, keepdims=True), 1e-30)
        shares = np.add.reduceat(part, begins, axis=0) / words[:, None]
    each = np.einsum("ij,ij->i", likelihood, shares[document])
    return shares, np.add.reduceat(np.log(np.maximum(each, 1e-30)), begins)


def infer(texts: list[str | None], model: Model, background: bool = False) -> list[dict[str, float]]:
    """Per text its languages and their proportions (summing to 1); empty for null texts and texts without a letter.
    With `background`, words that no language explains have a share of their own, as UNKNOWN."""
    found: list[dict[str, float]] = [{} for _ in texts]
    tables, rows = [], []
    for row, text in enumerate(texts):
        table = _word_likelihoods(text, model, background) if text and model.languages else ()
        if len(table):
            tables.append(table)
            rows.append(row)
    if not rows:
        return found
    likelihood = np.concatenate(tables)
    words = np.array([len(t) for t in tables])
    begins, document = np.cumsum(words) - words, np.repeat(np.arange(len(words)), words)
    count, width = len(model.languages), likelihood.shape[1]
    full, _ = _em(likelihood, begins, document, words, np.full((len(words), width), 1 / width, np.float32), ROUNDS)
    ranks = np.full(full.shape, -1)  # the background is in every set
    ranks[:, :count] = np.argsort(np.argsort(-full[:, :count], axis=1, kind="stable"), axis=1, kind="stable")
    best, best_score = np.zeros_like(full), np.full(len(words), -np.inf)
    left = np.arange(len(words))  # texts whose sets still grow
    for k in range(1, count + 1):  # nested candidate sets: the k largest shares
        shares = np.where(ranks[left] < k, np.maximum(full[left], 1e-6), 0)
        shares, logs = _em(likelihood, begins, document, words, (shares / shares.sum(axis=1, keepdims=True)).astype(np.float32),
                           0 if k == 1 and not background else 2)
        better = logs - PENALTY * (k - 1) * np.log(words + 1) > best_score[left]
        best[left[better]] = shares[better]
        best_score[left[better]] = (logs - PENALTY * (k - 1) * np.log(words + 1))[better]
        # A set that grows past three languages does so while that pays.
        stay = better if k > 2 else np.ones(len(left), bool)
        if not stay.any():
            break
        if not stay.all():
            likelihood, words, left = likelihood[stay[document]], words[stay], left[stay]
            begins, document = np.cumsum(words) - words, np.repeat(np.arange(len(words)), words)
    names = [*model.languages, UNKNOWN]
    for row, shares in zip(rows, best):
        found[row] = {names[k]: float(shares[k]) for k in np.flatnonzero(shares > 0)}
    return found


def _groups(texts: list[str | None], model: Model) -> Iterator[list[str | None]]:
    """Runs of texts of about PIECE characters together, fewer where the model has very many languages."""
    group, held, size = [], 0, PIECE * HELD_LANGUAGES // max(HELD_LANGUAGES, len(model.languages))
    for text in texts:
        group.append(text)
        held += len(text or "")
        if held >= size:
            yield group
            group, held = [], 0
    if group:
        yield group


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, proportions) for each row of `docs` (doc_id, text, others ignored).

    `und` with score 0 where text is null or has no letter, or the model knows no language. Equal shares go
    to the first language by name. Repeated rows get equal results; nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            shares = [x for group in _groups(texts, model) for x in infer(group, model)]
            top = [max(s.items(), key=lambda x: (x[1], [-ord(c) for c in x[0]])) if s else (UNKNOWN, 0.0) for s in shares]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([t[0] for t in top], pa.string()), pa.array([min(1.0, t[1]) for t in top], pa.float64()),
                 pa.array([list(s.items()) for s in shares], pa.map_(pa.string(), pa.float64()))],
                ["doc_id", "lang_pred", "score", "proportions"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, proportions map<string,double>")


def held_out(doc_id: str = "doc_id"):
    """The evaluation fold: crc32 of the id as text leaves no remainder by 5. A null id is in no fold."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def accepted(docs: DataFrame, model: Model, least: float = 0.4) -> DataFrame:
    """The rows of `docs` where one language has a share of at least `least` of the words, and no less than the words
    that no language explains; all columns stay."""
    names = docs.columns
    text = names.index("text")

    def good(shares: dict[str, float]) -> bool:
        unknown = shares.pop(UNKNOWN, 0.0)
        return bool(shares) and max(shares.values()) >= max(least, unknown)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).to_pylist()
            shares = [x for group in _groups(texts, model) for x in infer(group, model, background=True)]
            yield batch.filter(pa.array([good(s) for s in shares], pa.bool_())).rename_columns(names)

    return by_place(docs).mapInArrow(run, docs.schema)
