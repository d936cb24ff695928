"""Deterministic automata over bytes: rule regexes, subset construction, minimisation, transition arrays.

Helper of the secret scan. A rule may use literals, classes, groups, alternation and repetition."""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as C
from re import _parser

_CATEGORY = {C.CATEGORY_DIGIT: frozenset(range(48, 58)),
             C.CATEGORY_SPACE: frozenset(b" \t\n\r\x0b\x0c"),
             C.CATEGORY_WORD: frozenset(b for b in range(128) if chr(b).isalnum() or b == 95)}


class _Nfa:
    """Thompson's construction: `step[s]` lists (bytes, target), `free[s]` targets without input."""

    def __init__(self, fold: bool, backward: bool):
        self.step, self.free, self.fold, self.backward = [], [], fold, backward

    def state(self) -> int:
        self.step.append([])
        self.free.append([])
        return len(self.step) - 1

    def _set(self, values) -> frozenset:
        if not self.fold:
            return frozenset(values)
        return frozenset(y for x in values for y in ((x, x ^ 32) if chr(x).isalpha() and x < 128 else (x,)))

    def _class(self, items) -> frozenset:
        out = set()
        for op, arg in items:
            if op is C.LITERAL:
                out.add(arg)
            elif op is C.RANGE:
                out.update(range(arg[0], arg[1] + 1))
            elif op is C.CATEGORY:
                out |= _CATEGORY[arg]
        out = self._set(out)
        return frozenset(range(256)) - out if items[0][0] is C.NEGATE else out

    def add(self, nodes, at: int) -> int:
        for op, arg in reversed(nodes) if self.backward else nodes:
            at = self._one(op, arg, at)
        return at

    def _one(self, op, arg, at: int) -> int:
        if op in (C.LITERAL, C.NOT_LITERAL, C.IN, C.ANY):
            if op is C.IN:
                over = self._class(arg)
            else:
                over = self._set({arg}) if op is C.LITERAL else frozenset(range(256)) - (self._set({arg}) if arg else {10})
            to = self.state()
            self.step[at].append((over, to))
            return to
        if op is C.SUBPATTERN:
            return self.add(list(arg[3]), at)
        if op is C.BRANCH:
            end = self.state()
            for way in arg[1]:
                self.free[self.add(list(way), at)].append(end)
            return end
        if op is C.MAX_REPEAT:
            low, high, body = arg[0], arg[1], list(arg[2])
            for _ in range(low):
                at = self.add(body, at)
            if high is C.MAXREPEAT:
                loop = self.state()
                self.free[at].append(loop)
                self.free[self.add(body, loop)].append(loop)
                return loop
            end = self.state()
            for _ in range(high - low):
                self.free[at].append(end)
                at = self.add(body, at)
            self.free[at].append(end)
            return end
        raise ValueError(f"{op} is not for an automaton")


@dataclass(frozen=True)
class Automaton:
    """letters[byte] is the byte's letter (bytes that no rule tells apart share one) and table[state + letter]
    the next state; accepting states are those from `accepting` on, `rules[state]` names the rules accepted
    there. A state from which nothing can be accepted is `dead`."""

    letters: bytes
    table: list
    start: int
    accepting: int
    rules: dict
    dead: int


def compile_rules(patterns: list[tuple[str, bool]], anywhere: bool = False, backward: bool = False) -> Automaton:
    """One minimal automaton for all `patterns` (regex, either case). `anywhere`: a match may begin at any byte."""
    nfas = []
    for rule, (pattern, fold) in enumerate(patterns):
        nfa = _Nfa(fold, backward)
        begin = nfa.state()
        nfas.append((nfa, begin, nfa.add(list(_parser.parse(pattern)), begin), rule))

    def closed(states):
        todo, out = list(states), set(states)
        while todo:
            k, s = todo.pop()
            for to in nfas[k][0].free[s]:
                if (k, to) not in out:
                    out.add((k, to))
                    todo.append((k, to))
        return frozenset(out)

    # Bytes that no rule tells apart are one letter.
    sets = list({over for nfa, *_ in nfas for out in nfa.step for over, _ in out})
    letters: dict[tuple, list[int]] = {}
    for b in range(256):
        letters.setdefault(tuple(b in s for s in sets), []).append(b)
    letters_of = list(letters.values())

    first = closed({(k, begin) for k, (_, begin, _, _) in enumerate(nfas)})
    index, order, moves = {first: 0}, [first], []
    for at in order:  # subset construction; `order` grows
        row = []
        for members in letters_of:
            b = members[0]
            to = {(k, t) for k, s in at for over, t in nfas[k][0].step[s] if b in over}
            to = closed(to) | (first if anywhere else frozenset())
            if to not in index:
                index[to] = len(order)
                order.append(to)
            row.append(index[to])
        moves.append(row)
    accepts = [frozenset(rule for k, s in at for end, rule in [nfas[k][2:4]] if s == end) for at in order]

    part = {}  # minimisation: refine classes of states until none splits
    block = [part.setdefault(a, len(part)) for a in accepts]
    while True:
        part = {}
        new = [part.setdefault((block[s], tuple(block[t] for t in moves[s])), len(part)) for s in range(len(order))]
        if len(part) == len(set(block)):
            break
        block = new
    found = {}
    for s, k in enumerate(new):
        found.setdefault(k, s)
    ranked = sorted(found, key=lambda k: bool(accepts[found[k]]))
    width = len(letters_of)
    place = {k: width * i for i, k in enumerate(ranked)}
    table = [place[new[to]] for k in ranked for to in moves[found[k]]]
    letter = bytearray(256)
    for i, members in enumerate(letters_of):
        for b in members:
            letter[b] = i
    quiet = sum(not accepts[found[k]] for k in ranked)
    dead = next((place[k] for k in ranked if not accepts[found[k]] and all(new[t] == k for t in moves[found[k]])), -1)
    return Automaton(bytes(letter), table, place[new[0]], width * quiet,
                     {place[k]: sorted(accepts[found[k]]) for k in ranked if accepts[found[k]]}, dead)


def linked_rows(automaton: Automaton) -> list[list]:
    """The same automaton as rows that hold the next row itself, or the number of an accepting state. A pass
    is then one indexing per byte, and indexing a number is what stops it at an accepting state."""
    width = max(automaton.letters) + 1
    rows = [[] for _ in range(len(automaton.table) // width)]
    for k, row in enumerate(rows):
        for to in automaton.table[k * width:(k + 1) * width]:
            row.append(to if to >= automaton.accepting else rows[to // width])
    return rows
