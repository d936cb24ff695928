"""Secret scan: all rules run as one minimal deterministic automaton, in one pass over a text's bytes.

Where the pass reaches an accepting state, the rule's backward automaton finds where the match begins
and its forward automaton where it ends; matches of a rule are leftmost and do not overlap. A rule's
further conditions (least lengths) are then checked on the match, and failing ones are dropped."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadvault.llm.automaton import compile_rules, linked_rows
from leadvault.llm.common import by_place


@dataclass(frozen=True)
class Rule:
    """`pattern` over ASCII; `fold`: letters in either case; the match, or its group `group`, has `least`
    characters or more. No match of a rule may begin inside the part of another that precedes its first
    accepted byte (true of key = value and of prefix + run forms). `tail`: what may follow the pattern and then
    belongs to the match, as much of it as there is; only the rule's forward automaton knows it."""

    kind: str
    pattern: str
    fold: bool = False
    group: int = 0
    least: int = 1
    tail: str = ""


# The three base rules, in their order.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    # Runs of 16 or more: the same as all runs less the short ones, and the pass stays quiet in words.
    Rule("hex", r"[0-9a-f]{16,}", least=16),
)
# What follows a key's header: anything without five dashes in a row up to the end marker (quoted, escaped and
# indented keys too); or, where a key is cut, its header lines and the runs of base64, the last one of any length.
_BETWEEN, _RUN = r"([^A-Za-z0-9+/=-]|\\[nrt]| \+)", r"[A-Za-z0-9+/=]"
_WHOLE_KEY = r"([^-]|--?-?-?[^-])*-----+END ([A-Z]+ )*PRIVATE KEY-----"
_CUT_KEY = (rf"({_BETWEEN}*(Proc-Type|DEK-Info|Comment|Version): [^\r\n\\]*)*"
            rf"(({_BETWEEN}*{_RUN}{{16,}})+({_BETWEEN}+{_RUN}+)?|{_BETWEEN}*([\r\n]|\\[nr]){_BETWEEN}*{_RUN}+)?({_BETWEEN}*-----+END[A-Z ]*-*)?")
#: Further public token formats.
MORE = (
    Rule("private_key", r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----", tail=f"({_WHOLE_KEY}|{_CUT_KEY})"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", least=20),
)
RULES = BASE + MORE


@lru_cache(maxsize=8)
def _compiled(rules: tuple[Rule, ...]):
    patterns = [(r.pattern, r.fold) for r in rules]
    combined = compile_rules(patterns, anywhere=True)
    return (combined, linked_rows(combined), [compile_rules([(r.pattern + r.tail, r.fold)]) for r in rules],
            [compile_rules([p], backward=True) for p in patterns],
            [re.compile(r.pattern.encode(), re.IGNORECASE if r.fold else 0) for r in rules])


def _farthest(automaton, data: bytes, positions) -> int | None:
    """The last of `positions` (byte indexes, in scan order) after which the automaton accepts."""
    letters, table, state, found = automaton.letters, automaton.table, automaton.start, None
    for i in positions:
        state = table[state + letters[data[i]]]
        if state >= automaton.accepting:
            found = i
        elif state == automaton.dead:
            break
    return found


def find(data: bytes, rules: tuple[Rule, ...] = RULES) -> list[tuple[int, int, int]]:
    """(start, end, rule number) in bytes, by start, then rule."""
    combined, rows, forward, backward, exact = _compiled(rules)
    width, done, found = max(combined.letters) + 1, [0] * len(rules), []

    def accepted(state: int, i: int) -> None:
        for r in combined.rules[state]:
            if i < done[r]:
                continue
            start = _farthest(backward[r], data, range(i, done[r] - 1, -1))
            if start is None:
                continue
            done[r] = end = _farthest(forward[r], data, range(start, len(data))) + 1
            size = len(exact[r].fullmatch(data, start, end).group(rules[r].group)) if rules[r].group else end - start
            if size >= rules[r].least:
                found.append((start, end, r))

    ahead, row = iter(data.translate(combined.letters)), rows[combined.start // width]
    while True:
        try:
            for letter in ahead:
                row = row[letter]
            if isinstance(row, int):
                accepted(row, len(data) - 1)
            break
        except TypeError:  # `row` is an accepting state, reached one byte before `letter`
            accepted(row, len(data) - ahead.__length_hint__() - 2)
            row = rows[row // width][letter]
    return sorted(found, key=lambda x: (x[0], x[2]))


def spans(text: str | None, rules: tuple[Rule, ...] = RULES) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, end exclusive; none for a null or empty text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    found = find(data, rules)
    if found and not data.isascii():
        at = {p: len(data[:p].decode("utf-8", "surrogatepass")) for s, e, _ in found for p in (s, e)}
        found = [(at[s], at[e], r) for s, e, r in found]
    return [(rules[r].kind, s, e) for s, e, r in found]


def _digest(found) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in found)


SPANS = "doc_id long, spans array<struct<kind:string,start:long,end:long>>"


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans) for each row of `docs` (doc_id, text, others ignored). Null and empty texts have
    no spans; repeated rows and null ids pass through; nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            found = [[dict(kind=k, start=s, end=e) for k, s, e in spans(t.as_py(), rules)] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SPANS)


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the hash of the base spans and all spans as text, per row of `secret_spans`."""
    base = [r.kind for r in BASE]

    def joined(spans_):
        return F.array_join(F.transform(spans_, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(k) for k in base],
        F.sha2(joined(F.filter("spans", lambda x: x["kind"].isin(base))), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """`docs` with every span of `text` replaced by `mark` (overlapping spans once); other columns as they
    are, null texts stay null, texts without secrets are untouched."""
    names = docs.columns
    text = names.index("text")

    def cleaned(value):
        found = spans(value, rules) if value else []
        out, at = [], 0
        for _, start, end in found:
            if start >= at:
                out += [value[at:start], mark]
            at = max(at, end)
        return "".join([*out, value[at:]]) if found else value

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([cleaned(t.as_py()) for t in batch.column(text)], pa.string())
            yield pa.RecordBatch.from_arrays([texts if k == text else batch.column(k) for k in range(len(names))], names)

    return by_place(docs).mapInArrow(run, docs.schema)
