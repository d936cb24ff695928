"""Ranked search, decontamination and conversation repair against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from leadvault.llm import decontaminate, lemp, repair
from leadvault.llm.common import ship_code
from leadvault.llm.fm_index import FmIndex, suffix_ranks
from leadvault.llm.term_shards import terms

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, row string, n_words int, window string, score double, df int"
ITEMS = "item_id long, text string, query int, row int"


def split(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def spoken(rng, n, common=40):
    return " ".join(rng.choice(["é", "The", "of-", "x9,", "ÀB"]) if rng.random() < 0.3 else f"w{int(rng.expovariate(1 / common))}" for _ in range(n))


@pytest.fixture(scope="module")
def items():
    rng = random.Random(3)
    rows = [(k, spoken(rng, rng.randint(12, 40))) for k in range(30)]
    return rows + [(30, "The é of x9"), (31, ""), (32, None), (33, "..."), (None, rows[0][1]), (5, spoken(rng, 20)), rows[6], (34, rows[7][1]),
                   (35, "never seen"), (-1, spoken(rng, 15))]


@pytest.fixture(scope="module")
def rows(items):
    """Nulls, empty and long texts, repeats, passages of items, some of them in a third of all rows."""
    rng = random.Random(4)
    out = [(0, None), (1, ""), (2, " .\n"), (3, "The é of x9"), (4, items[0][1])]
    for k in range(5, 150):
        text = spoken(rng, rng.randint(0, 80))
        if k % 3 == 0:
            text = f"{text}\n{items[7][1].upper()} {spoken(rng, 5)}"
        elif k % 4 == 0:
            text += " " + " ".join(split(items[k % 30][1])[2:14]) + "! " + spoken(rng, 9)
        out.append((k, text))
    return out + [(150, spoken(rng, 4000) + " " + items[9][1] + " " + items[10][1]), (None, items[11][1]), (None, None), out[20], (20, items[12][1])]


@pytest.fixture(scope="module")
def tables(spark, rows, items):
    ship_code(spark)
    docs = spark.createDataFrame([(*r, "x", 1, "w", 0.5, 3) for r in rows], DOCS)
    return docs, spark.createDataFrame([(*r, 1, 2) for r in items], ITEMS)


def test_terms():
    text = "AZ az09 @[`{ \x00\x7f é É_İ x" + chr(0x10ffff)
    assert [t.decode() for t in terms(text.encode())] == split(text) and terms(None) == []


def brute_ranking(rows, items, top):
    docs = [(d, Counter(split(t))) for d, t in rows]
    docs = [(d, c) for d, c in docs if c]
    n_docs, n_terms = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in docs:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                        for t in split(text) if t in c)
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, k, s[3], -s[0]) for k, s in enumerate(sorted(scores)[:top], 1)]
    return out


@pytest.mark.parametrize("shard_terms,block_terms,block_queries", [(1 << 20, 1 << 16, 256), (300, 20, 5)])
def test_ranked(spark, tables, rows, items, shard_terms, block_terms, block_queries, monkeypatch):
    monkeypatch.setattr(lemp, "FIRST_BUCKET", 2 if block_terms == 20 else 64)
    got = lemp.ranked(spark, *tables, 20, shard_terms, block_terms, block_queries).collect()
    assert Counter(map(tuple, got)) == Counter(brute_ranking(rows, items, 20))


def test_buckets_leave_out_only_what_cannot_win():
    """On vectors of very unequal length, most buckets are never read and the best are still exact."""
    rng = random.Random(8)
    block = lemp._Queries([{"query": q, "item_id": q, "terms": [{"term": b"t%d" % t, "times": 1, "weight": 50 + t} for t in rng.sample(range(40), 8)]}
                           for q in range(6)])
    count = 3000
    term = [np.array(sorted(rng.sample(range(40), rng.choice([1, 1, 1, 2, 12])))) for _ in range(count)]
    tf = [np.array([rng.choice([1, 1, 1, 30]) for _ in t]) for t in term]
    n = np.array([int(f.sum()) * rng.choice([1, 40]) for f in tf])
    known = {b"t%d" % t: t for t in range(40)}
    read = []

    def seen():
        for bucket in lemp.buckets(known, block, n, np.cumsum([len(t) for t in term]), np.concatenate(term), np.concatenate(tf), count, int(n.sum())):
            read.append(len(bucket.number))
            yield bucket

    got = lemp.best(block, seen(), np.arange(count), 5)
    weight = dict(zip(block.words, block.weight.tolist()))
    for (docs, scores), numbers in zip(got, block.term):
        asked = [list(block.words)[k] for k in numbers]
        want = []
        for d in range(count):
            m = 75 + int(25 * n[d] * count // n.sum())
            has = dict(zip(term[d].tolist(), tf[d].tolist()))
            want.append((-sum(weight[w] * ((10**9 * has[known[w]]) // (1000 * has[known[w]] + 12 * m)) for w in asked if known[w] in has), d))
        assert [(-s, d) for d, s in zip(docs.tolist(), scores.tolist())] == sorted(want)[:5]
    assert sum(read) < count / 2


def brute_hits(rows, items):
    found = defaultdict(set)
    for item, text in items:
        words = split(text)
        for k in range(max(len(words) - 10, 0) + 1 if words else 0):
            found[tuple(words[k:k + 10])].add(item)
    out = []
    for d, text in rows:
        words = split(text)
        hit, names = set(), set()
        for size in {len(w) for w in found}:
            for k in range(len(words) - size + 1):
                if (w := tuple(words[k:k + size])) in found:
                    hit |= set(range(k, k + size))
                    names |= {str(i) for i in found[w] if i is not None}
        out.append((d, len(words), tuple(sorted(hit)), tuple(sorted(names))))
    return out


@pytest.mark.parametrize("shard_terms,block_windows", [(1 << 20, 1 << 16), (60, 40)])
def test_decontaminate(spark, tables, rows, items, shard_terms, block_windows):
    got = decontaminate.decontaminate(spark, *tables, 10, shard_terms, block_windows).collect()
    mine = [(r["doc_id"], r["n_words"], tuple(w for a, b in r["spans"] for w in range(a, b)), tuple(r["items"])) for r in got]
    assert Counter(mine) == Counter(brute_hits(rows, items))
    by_id = {r["doc_id"]: r for r in got}
    cut = decontaminate.without(rows[150][1], [(a, b) for a, b in by_id[150]["spans"]])
    assert split(cut) == [w for k, w in enumerate(split(rows[150][1])) if not any(a <= k < b for a, b in by_id[150]["spans"])]
    assert decontaminate.without(None, [(0, 1)]) is None and decontaminate.without("a b", []) == "a b"


def test_fm_index():
    rng = random.Random(3)
    for trial in range(60):
        docs = [[rng.randint(1, 3) for _ in range(rng.randint(0, 30))] for _ in range(rng.randint(1, 6))] * (1 + trial % 2)
        symbols = np.array([x for d in docs for x in [*d, 0]])
        zeros = np.cumsum(symbols == 0)
        told = [-9 + int(zeros[k]) * 0.01 if x == 0 else x for k, x in enumerate(symbols)]
        assert suffix_ranks(symbols).argsort().tolist() == sorted(range(len(told)), key=lambda k: told[k:])
        index = FmIndex.unpacked(FmIndex.build(symbols).packed())
        phrases = [[rng.randint(1, 4) for _ in range(n)] for n in (1, 2, 3, 5) for _ in range(8)]
        low, high = index.search(np.array([[0] * (5 - len(p)) + [x if x <= symbols.max() else -1 for x in p] for p in phrases]))
        for p, a, b in zip(phrases, low, high):
            assert sorted(index.locate(np.arange(a, b))) == [k for k in range(len(symbols)) if symbols[k:k + len(p)].tolist() == p]


CONVERSATIONS = "conv_id long, turn long, role string, text string, slice long, cost int, told string"


def in_turn(row):
    return row[0] is not None, row[0] or 0, hashlib.sha256(f"{row[1]}\0{row[2]}".encode()).hexdigest()


def brute_repair(rows):
    """Every path's cost and audit, the least per grammar state kept row by row."""
    next_ = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    given = (("user", "u"), ("assistant", "a"))
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv]
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        convs[conv] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv, found in convs.items():
        found.sort(key=in_turn)
        turns = [t for t, *_ in found if t is not None]
        faults, seen = [], set()
        for _, role, text in found:
            solid = re.findall(r"[^\x20\x09-\x0d]", text)
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None)
            seen.add((role, text))

        def inserted(states):
            for _ in range(3):
                for state, (cost, audit, said) in list(states.items()):
                    for role, initial in given:
                        put(states, next_[state].get(initial), (cost + 3, audit + "I", [*said, (role, "")]))
            return states

        def put(states, state, way):
            if state is not None and (state not in states or way[:2] < states[state][:2]):
                states[state] = way

        states = inserted({"": (0, "", [])})
        for (_, role, text), fault in zip(found, faults):
            after, more = {}, 3 * (fault == "truncated")
            for state, (cost, audit, said) in states.items():
                put(after, state, (cost + 4, audit + "D", said))
                if fault not in ("blank", "duplicate"):
                    put(after, next_[state].get(role[:1]), (cost + more, audit + "K", [*said, (role, text)]))
                    for to, initial in given:
                        put(after, next_[state].get(initial), (cost + 3 + more, audit + "R", [*said, (to, text)]))
            states = inserted(after)
        cost, audit, said = min((states[s] for s in ("", "a") if s in states), key=lambda w: w[:2])
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(found, found[1:]))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                     illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest())
    return out


def conversations():
    rng = random.Random(1)
    rows = []
    for conv in [None, *range(60)]:
        rows += [(conv, rng.choice([None, k, k, k, k + 5, 3]), rng.choice(["system", "user", "assistant", "assistant", "user", "tool", None, ""]),
                  rng.choice(["Hi.", "Yes?", "no", "", " \n", "Well \t", None, f"x{k}.", "é" * 300])) for k in range(rng.choice([1, 2, 3, 8, 30]))]
    # One conversation with more than a third of all rows, one with equal rows only.
    rows += [(100, k, rng.choice(["user", "assistant"]), rng.choice(["a.", "b", f"c{k}.", f"c{k}!"])) for k in range(700)]
    return rows + [(101, None, "user", "same.")] * 150 + [(101, 5, "user", "same.")] * 50


@pytest.mark.parametrize("slice_rows", [4096, 7])
def test_repair(spark, slice_rows):
    rows = conversations()
    table = ship_code(spark).createDataFrame([(*r, 1, 2, "t") for r in rows], CONVERSATIONS)
    got = {r[0]: tuple(r)[1:] for r in repair.repair_damaged(spark, table.repartition(5), slice_rows).collect()}
    assert got == brute_repair(rows)


def test_empty_tables(spark, tables):
    docs, items = tables
    none, no_items = docs.limit(0), items.limit(0)
    assert lemp.ranked(spark, none, items).count() == lemp.ranked(spark, docs, no_items).count() == 0
    assert decontaminate.decontaminate(spark, none, items).count() == 0
    clean = decontaminate.decontaminate(spark, docs, no_items).collect()
    assert len(clean) == docs.count() and not any(r["spans"] or r["items"] for r in clean)
    assert repair.repair_damaged(spark, spark.createDataFrame([], CONVERSATIONS)).count() == 0
