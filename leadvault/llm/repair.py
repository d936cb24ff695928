"""Conversation structure repair: cost dynamic programme, then prefix-doubling path ranking.

A conversation's rows are edited (Keep, Delete, Rerole, Insert) so that its roles read `(s?(ua)+)?`, at least cost, and
among the cheapest edits those whose audit string is ASCII-least. Nodes are (rows done, state of the
grammar); an arc is one edit and one audit letter, and the state tells which role a Rerole or an Insert gives.

The cost to the end of every node is computed from the last row to the first, for all conversations of a batch at once;
arcs on cheapest paths are optimal. The letters of a node's arcs differ, so its least audit of any length fixes the
node it leads to. Nodes are ranked by their least audits of 1, 2, 4, ... letters: the rank of twice the length is
that of the pair (own rank, rank of the node this audit leads to), and pointers double alike. Nodes of equal last rank have
equal audits, so one path is read per rank, by the doubled pointers.

Rows are range-partitioned in order, so a long conversation lies in many tasks. It is cut into slices; a slice's least
costs between grammar states are a 4 x 4 matrix, and only these are brought together per conversation."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadvault.llm.common import stored
from leadvault.llm.term_shards import rows_of

#: Rows of a slice; characters after which it ends too; rows that are solved together.
SLICE_ROWS, SLICE_CHARS, BATCH_ROWS = 4096, 1 << 22, 1 << 14
#: Conversations of more rows than this are solved apart from the others.
LONG_ROWS = 64

_FOREVER = 1 << 60
#: Grammar states: nothing said, system said, user said, assistant said. May end in the first and the last.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_MAY_END = np.array([0, _FOREVER, _FOREVER, 0])
#: The state after a Rerole or Insert, whose role it tells.
_GIVEN = np.array([_USER, _USER, _ASSISTANT, _USER])
#: The state after keeping a row, by state and initial (s, u, a, other); -1: can't be kept.
_KEPT = np.array([[_SYSTEM, _USER, -1, -1], [-1, _USER, -1, -1], [-1, -1, _ASSISTANT, -1], [-1, _USER, -1, -1]])
_INITIALS = {"s": 0, "u": 1, "a": 2}
#: What edits cost.
_DELETE, _REROLE, _INSERT, _TRUNCATED = 4, 3, 3, 3
#: Letters by rank.
_LETTERS = np.frombuffer(b"\0DIKR", np.uint8)
_ROLES = {_USER: "user", _ASSISTANT: "assistant"}


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, times) after the damage of the exercise: by crc32 of `conv_id:turn` modulo 20 a row
    is dropped, emptied, robbed of its full stops, doubled or made the user's. Null texts, roles and parts of the key are
    one space; null ids and turns stay."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    return conversations.select("conv_id", "turn", "role", "text", kind.alias("_kind")).where("_kind <> 0").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.when(F.col("_kind") == 4, "user").otherwise(blank("role")).alias("role"),
        text.alias("text"), F.when(F.col("_kind") == 3, 2).otherwise(1).cast("long").alias("times"))


def _closed(costs: np.ndarray) -> np.ndarray:
    """Least costs to the end where rows may be inserted first. The second axis is the state."""
    out = costs.copy()
    for _ in range(3):
        np.minimum(out, out[:, _GIVEN] + _INSERT, out=out)
    return out


class Slices:
    """Many slices of conversations, their rows one after the other: initials, whether a row must be deleted, whether it
    is truncated. `ends` has the number of rows up to each slice's end, `after` the costs to the conversation's
    end by state behind each slice."""

    def __init__(self, initial: np.ndarray, dead: np.ndarray, truncated: np.ndarray, ends: np.ndarray):
        self.initial, self.dead, self.extra, self.ends = initial, dead, truncated * _TRUNCATED, ends
        self.sizes = np.diff(ends, prepend=0)
        self.begins = ends - self.sizes

    def _costs(self, after: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(numbers of slices, costs) from behind the last row to before the first; costs have one more axis than the state where `after` has."""
        by_size = np.argsort(-self.sizes, kind="stable")
        costs = after[by_size]
        yield by_size, costs
        wide = (slice(None), None) + (None,) * (after.ndim - 2)
        for step in range(1, int(self.sizes.max(initial=0)) + 1):
            some = by_size[:np.searchsorted(-self.sizes[by_size], -step, side="right")]
            row = self.ends[some] - step
            left, extra, dead = costs[:len(some)], self.extra[row][wide], self.dead[row]
            kept = _KEPT[:, self.initial[row]].T
            each = np.arange(len(some))[:, None]
            live = np.minimum(np.where((kept >= 0)[(...,) + (None,) * (after.ndim - 2)], left[each, kept], _FOREVER),
                              left[:, _GIVEN] + _REROLE) + extra
            live[dead] = _FOREVER
            costs = _closed(np.minimum(live, left + _DELETE))
            yield some, costs

    def matrices(self) -> np.ndarray:
        """slices x 4 x 4: the least cost from a state before a slice to one behind it."""
        ends = np.where(np.eye(4, dtype=bool), 0, _FOREVER)
        out = np.broadcast_to(ends, (len(self.ends), 4, 4)).copy()
        for some, costs in self._costs(out.copy()):
            out[some] = np.minimum(costs, _FOREVER)
        return out

    def solve(self, after: np.ndarray, last: np.ndarray, entries: list[int]) -> tuple[np.ndarray, list[list[str]], np.ndarray]:
        """(cost to the end, audits, state behind the slice) by slice and entry state. In slices that are `last` rows may
        be inserted at the end; elsewhere that belongs to the next slice. Entries without a way are given no audit and
        state -1."""
        after = np.where(last[:, None], _closed(after), after)
        base = (self.begins + np.arange(len(self.ends))) * 4  # a slice's nodes: one per state before each row and behind the last
        nodes = (int(self.ends[-1]) + len(self.ends)) * 4 if len(self.ends) else 0
        cost = np.empty(nodes, np.int64)
        for k, (some, costs) in enumerate(self._costs(after)):
            at = base[some] + (self.sizes[some] - k) * 4
            cost[at[:, None] + np.arange(4)] = costs
        pointer, rank = self._least_arcs(cost, after, last, base)
        doubled = [pointer]
        while (pointer[pointer] != pointer).any():
            rank = np.unique(rank * (rank.max() + 1) + rank[pointer], return_inverse=True)[1]
            pointer = pointer[pointer]
            doubled.append(pointer)
        first = base[:, None] + np.array(entries)
        _, chosen, of = np.unique(rank[first], return_index=True, return_inverse=True)
        # Audits of one path per rank: the pointer of 2 ** k letters leads from the first 2 ** k nodes to the next.
        path = first.ravel()[chosen][:, None]
        for ahead in doubled:
            path = np.concatenate([path, ahead[path]], axis=1)
        letters = _LETTERS[self._letter[path]]
        audits = [row.tobytes().rstrip(b"\0").decode() for row in letters]
        exit_ = pointer[first]
        exits = (exit_ - base[:, None] - self.sizes[:, None] * 4)
        closed = cost[first] >= _FOREVER // 2
        told = np.array(audits, object)[of.reshape(first.shape)] if len(audits) else np.zeros(first.shape, object)
        told[closed], exits[closed] = None, -1
        return cost[first], told.tolist(), exits

    def _least_arcs(self, cost: np.ndarray, after: np.ndarray, last: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(node its least optimal arc leads to, rank of the arc's letter) per node; nodes that no arc leaves lead to themselves
        and rank least."""
        nodes = len(cost)
        node = np.arange(nodes)
        state = node % 4
        slice_ = np.repeat(np.arange(len(self.ends)), (self.sizes + 1) * 4)
        place = (node - base[slice_]) // 4
        inside = place < self.sizes[slice_]
        row = np.where(inside, self.begins[slice_] + place, 0)
        initial, dead = (np.append(x, 0)[np.where(inside, row, len(x))] for x in (self.initial, self.dead))
        extra = np.append(self.extra, 0)[np.where(inside, row, len(self.extra))]
        possible = cost < _FOREVER // 2
        pointer, letter = node.copy(), np.zeros(nodes, np.int64)

        def arc(rank, target, price, allowed):
            free = allowed & possible & (letter == 0)
            target = np.where(free, target, node)
            free &= cost[target] + price == cost
            pointer[free], letter[free] = target[free], rank

        live = inside & (dead == 0)
        kept = _KEPT[state, initial]
        given = node - state + _GIVEN[state]
        arc(1, node + 4, _DELETE, inside)
        arc(2, given, _INSERT, inside | last[slice_])
        arc(3, node + 4 - state + kept, extra, live & (kept >= 0))
        arc(4, given + 4, _REROLE + extra, live)
        self._letter = letter
        return pointer, letter


def repaired(audit: str, state: int, roles: list[str], texts: list[str]) -> Iterator[tuple[str, str]]:
    """(role, text) of the rows that the edits leave, from a grammar state on."""
    rows = zip(roles, texts)
    for letter in audit:
        if letter == "I":
            state = int(_GIVEN[state])
            yield _ROLES[state], ""
            continue
        role, text = next(rows)
        if letter == "K":
            state = int(_KEPT[state, _INITIALS[role[0]]])
            yield role, text
        elif letter == "R":
            state = int(_GIVEN[state])
            yield _ROLES[state], text


_COUNTS = ["blank", "duplicate", "truncated", "illegal"]
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
#: What a task gives for every slice. Slices that are whole conversations are solved at once, others keep their rows.
_PARTS = ("conv_id long, slice long, whole boolean, turns long, first_turn long, last_turn long, first_role string, last_role string, "
          "blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string, "
          "costs array<long>, roles array<string>, texts array<string>, dead array<boolean>, cut array<boolean>")


def _hashed(rows: Iterator[tuple[str, str]]) -> str:
    found = hashlib.sha256()
    for k, (role, text) in enumerate(rows):
        found.update(("\n" if k else "").encode() + f"{role}:{text}".encode())
    return found.hexdigest()


class _Slice:
    """Rows of one conversation in order, with what is counted about them."""

    def __init__(self, conv: int | None):
        self.conv, self.chars, self.turns, self.first_turn, self.last_turn = conv, 0, 0, None, None
        self.roles, self.texts, self.initial, self.dead, self.cut = [], [], [], [], []
        self.counts = dict.fromkeys(_COUNTS, 0)

    def add(self, turn: int | None, role: str, text: str, seen: bool) -> None:
        if turn is not None and turn != self.last_turn:
            self.turns, self.last_turn = self.turns + 1, turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
        if self.roles and (self.roles[-1][:1], role[:1]) not in _LEGAL:
            self.counts["illegal"] += 1
        end = text.rstrip(" \t\n\v\f\r")[-1:]
        fault = "blank" if not end else "duplicate" if seen else "truncated" if end not in ".!?" else None
        if fault:
            self.counts[fault] += 1
        self.roles.append(role)
        self.texts.append(text)
        self.initial.append(_INITIALS.get(role[:1], 3))
        self.dead.append(fault in ("blank", "duplicate"))
        self.cut.append(fault == "truncated")
        self.chars += len(text)

    def full(self, rows: int) -> bool:
        return len(self.roles) >= rows or self.chars >= SLICE_CHARS


def _together(slices: list[_Slice]) -> Slices:
    flat = lambda name, kind: np.array([x for s in slices for x in getattr(s, name)], kind)
    return Slices(flat("initial", np.int64), flat("dead", bool), flat("cut", np.int64), np.cumsum([len(s.roles) for s in slices]))


def _batch(slices: list[tuple[_Slice, bool, int]]) -> pa.RecordBatch:
    """The rows of _PARTS for (slice, whether it is a whole conversation, number)."""
    solved, parts = {}, [s for s, w, _ in slices if not w]
    for long in (False, True):  # a path takes as much room as the longest beside it
        some = [(s, number) for s, w, number in slices if w and (len(s.roles) > LONG_ROWS) == long]
        if some:
            costs, audits, _ = _together([s for s, _ in some]).solve(np.tile(_MAY_END, (len(some), 1)), np.ones(len(some), bool), [_START])
            solved |= {number: (c[0], a[0]) for (_, number), c, a in zip(some, costs.tolist(), audits)}
    matrices = iter(_together(parts).matrices().reshape(-1, 16).tolist() if parts else ())
    rows = []
    for s, w, number in slices:
        cost, audit = solved[number] if w else (None, None)
        sha = _hashed(repaired(audit, _START, s.roles, s.texts)) if w else None
        rest = [None] * 5 if w else [next(matrices), s.roles, s.texts, s.dead, s.cut]
        rows.append((s.conv, number, w, s.turns, s.first_turn, s.last_turn, s.roles[0][:1], s.roles[-1][:1], *s.counts.values(), cost, audit, sha, *rest))
    kinds = [pa.int64()] * 2 + [pa.bool_()] + [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()] * 5 + [pa.string()] * 2 + [
        pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.bool_()), pa.list_(pa.bool_())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], [c.split()[0] for c in _PARTS.split(", ")])


def _sliced(batches: Iterator[pa.RecordBatch], slice_rows: int) -> Iterator[pa.RecordBatch]:
    """Rows come in order of conversation and turn. A partition's first and last conversation may go on in its neighbours."""
    number, first, ready, size, chars = TaskContext.get().partitionId() << 32, True, [], 0, 0
    held, cut = None, False  # the slice being filled, and whether its conversation has others

    def close(last: bool) -> None:
        nonlocal number, first, size, chars
        ready.append((held, not (cut or first or last), number))
        number, first, size, chars = number + 1, False, size + len(held.roles), chars + held.chars

    for conv, turn, role, text, times, seen in rows_of(batches):
        if held is not None and held.conv != conv:
            close(False)
            first, held, cut = False, None, False
        for copy in range(times):
            if held is not None and held.full(slice_rows):
                cut = True
                close(False)
                held = None
                if size >= BATCH_ROWS or chars >= SLICE_CHARS:
                    yield _batch(ready)
                    ready, size, chars = [], 0, 0
            if held is None:
                held = _Slice(conv)
            held.add(turn, role, text, seen or copy > 0)
        if size >= BATCH_ROWS or chars >= SLICE_CHARS:
            yield _batch(ready)
            ready, size, chars = [], 0, 0
    if held is not None:
        close(True)
    if ready:
        yield _batch(ready)


def _backward(parts: pd.DataFrame) -> pd.DataFrame:
    """The costs to the end behind every slice of one conversation."""
    parts = parts.sort_values("slice", ignore_index=True)
    after, behind = [], _MAY_END
    for k in reversed(range(len(parts))):
        after.append(behind)
        open_ = _closed(behind[None, :])[0] if k == len(parts) - 1 else behind
        behind = np.minimum((np.reshape(parts["costs"][k], (4, 4)) + open_).min(axis=1), _FOREVER)
    return pd.DataFrame({"slice": parts["slice"], "after": after[::-1], "last": parts["slice"] == parts["slice"].max()})


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per slice and entry state: cost to the end, audit, state behind the slice."""
    for number, conv, after, last, roles, texts, dead, cut in rows_of(batches):
        initial = np.array([_INITIALS.get(r[:1], 3) for r in roles], np.int64)
        one = Slices(initial, np.array(dead, bool), np.array(cut, np.int64), np.array([len(roles)]))
        costs, audits, exits = one.solve(np.array([after]), np.array([last]), list(range(4)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([conv], pa.int64()), pa.array(costs.tolist(), pa.list_(pa.int64())),
             pa.array(audits, pa.list_(pa.string())), pa.array(exits.tolist(), pa.list_(pa.int64()))],
            ["slice", "conv_id", "costs", "audits", "exits"])


_TOTALS = ["gaps", *_COUNTS, "cost"]


def _forward(parts: pd.DataFrame) -> pd.DataFrame:
    """The state each slice of one conversation is entered in; beside the first, what the conversation has in total."""
    parts = parts.sort_values("slice", ignore_index=True)
    entries, state = [], _START
    for exits in parts["exits"]:
        entries.append(state)
        state = int(exits[state])
    told = parts[parts["first_turn"].notna()]
    shared = (told["last_turn"].shift() == told["first_turn"]).sum()
    gaps = 0 if told.empty else int(told["last_turn"].iloc[-1]) - int(told["first_turn"].iloc[0]) + 1 - (int(parts["turns"].sum()) - int(shared))
    legal = zip(parts["last_role"], parts["first_role"][1:])
    totals = {c: int(parts[c].sum()) for c in _COUNTS} | {"gaps": gaps, "cost": int(parts["costs"][0][_START])}
    totals["illegal"] += sum(pair not in _LEGAL for pair in legal)
    return pd.DataFrame({"slice": parts["slice"], "entry": entries} | {
        c: pd.array([totals[c]] + [None] * (len(parts) - 1), "Int64") for c in _TOTALS})


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices come in order of conversation and place: audits are strung together and the repaired rows hashed as they come."""
    audit, sha, held = [], None, None

    def whole() -> pa.RecordBatch:
        values = [*held, "".join(audit), sha.hexdigest()]
        kinds = [pa.int64()] * (len(held)) + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], ["conv_id", *_TOTALS, "audit", "repaired_sha256"])

    for conv, entry, part, roles, texts, *totals in rows_of(batches):
        if totals[0] is not None:
            if held is not None:
                yield whole()
            audit, sha, held, begun = [], hashlib.sha256(), [conv, *totals], False
        audit.append(part)
        for role, text in repaired(part, entry, roles, texts):
            sha.update(("\n" if begun else "").encode() + f"{role}:{text}".encode())
            begun = True
    if held is not None:
        yield whole()


def _in_order(rows: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text, times) by range of (conv_id, turn, role, text), nulls first, each different row
    once with how often it occurs, and `seen`: whether the conversation has its role and text in an earlier turn."""
    told: Column = F.sha2(F.concat("role", F.lit("\0"), "text"), 256)
    turn = F.struct(F.col("turn").isNotNull().alias("some"), "turn")
    again = rows.select("conv_id", told.alias("told"), turn.alias("turn")).groupBy("conv_id", "told").agg(
        F.min("turn").alias("first"), F.max("turn").alias("last")).where("first <> last")
    again = stored(rows.sparkSession, again.select(F.col("conv_id").alias("_conv"), F.col("told").alias("_told"), "first"), "again")
    folded = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("times").alias("times"))
    marked = folded.withColumn("told", told).join(
        again, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("told") == F.col("_told")), "left")
    seen = F.col("first").isNotNull() & (turn > F.col("first"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "told")]
    return marked.withColumn("seen", seen).repartitionByRange(*order).sortWithinPartitions(*order, "role", "text").select(
        "conv_id", "turn", "role", "text", "times", "seen")


def repair(spark: SparkSession, rows: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of `rows` (conv_id, turn, role,
    text, times), for every conversation that has rows.

    Rows are taken by turn, null turns first; within a turn in order of a hash of role and text, equal rows side by
    side. Null conv_ids are one conversation. A role that does not begin with s, u or a (or is empty) can't be kept as it is.
    Texts of any length are read whole. An empty table gives no rows.

    One conversation may hold any share of the rows: its slices are solved in any task, and what meets is one 4 x 4 matrix a
    slice. Only its repaired text is run through one task, slice by slice: a SHA-256 has no other way."""
    parts = stored(spark, _in_order(rows).mapInArrow(lambda batches: _sliced(batches, slice_rows), _PARTS), "slices")
    whole = parts.where("whole")
    gaps = F.when(F.col("first_turn").isNull(), 0).otherwise(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns")).cast("long")
    done = whole.select("conv_id", gaps.alias("gaps"), *_COUNTS, "cost", "audit", "repaired_sha256")
    open_ = parts.where("not whole")
    behind = open_.select("conv_id", "slice", "costs").groupBy("conv_id").applyInPandas(
        _backward, "slice long, after array<long>, last boolean")
    audits = stored(spark, open_.join(behind, "slice").select("slice", "conv_id", "after", "last", "roles", "texts", "dead", "cut").mapInArrow(
        _audited, "slice long, conv_id long, costs array<long>, audits array<string>, exits array<long>"), "audits")
    told = open_.select("slice", "turns", "first_turn", "last_turn", "first_role", "last_role", *_COUNTS)
    states = audits.select("conv_id", "slice", "costs", "exits").join(told, "slice").groupBy("conv_id").applyInPandas(
        _forward, "slice long, entry int, " + ", ".join(f"{c} long" for c in _TOTALS))
    chosen = audits.select("slice", "audits").join(states, "slice").join(open_.select("conv_id", "slice", "roles", "texts"), "slice")
    joined = chosen.repartition("conv_id").sortWithinPartitions("conv_id", "slice").select(
        "conv_id", "entry", F.element_at("audits", F.col("entry") + 1).alias("audit"), "roles", "texts", *_TOTALS).mapInArrow(_joined, done.schema)
    return done.unionByName(joined)


def repair_damaged(spark: SparkSession, conversations: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """`repair` of the `damage` of `conversations` (conv_id, turn, role, text, others ignored), a row for each of its
    conv_ids; where the damage left no row, all counts are 0 and nothing is repaired."""
    found = repair(spark, damage(conversations), slice_rows).withColumnRenamed("conv_id", "_conv")
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    numbers = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in _TOTALS]
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select(
        "conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
