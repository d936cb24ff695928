"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Each rule says good, bad or nothing about a document. A document is good, or has one defect per rule that looks
for it. EM over the counts of vote patterns (at most 3 ** rules rows, whatever the input) estimates, without
labels, the share of each kind and each rule's accuracy on it: how often its votes are bad ones. A document is kept by its posterior probability of being good, not for passing every rule.
DataFrame operations only; a document's features come from its own row, nothing is exploded."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadvault.llm.common import WORD, stored

MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
_SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
KEEP = 0.5
#: Beta priors of a rule's accuracy: their means, of the good documents it blames and of those with its defect it sees, and
#: their weight as a share of the rule's votes, so that data outweigh them alike at every size.
FALSE_ALARM, SEES, PRIOR_SHARE = 0.01, 0.9, 0.05
ROUNDS = 100


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated(words: Column) -> Column:
    """Number of words inside 3-word windows that occur twice or more in `words`: windows are sorted by hash, those
    equal to a neighbour are the repeated ones, and their places, sorted, cover min(3, distance) new words each."""
    last = F.size(words) - 3
    windows = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(
        F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("p")))

    def same(s, i, j):
        return F.coalesce(F.get(s, i)["h"] == F.get(s, j)["h"], F.lit(False))

    places = _let(F.sort_array(windows), lambda s: F.sort_array(F.transform(
        F.filter(s, lambda x, i: same(s, i, i - 1) | same(s, i, i + 1)), lambda x: x["p"])))
    covered = F.aggregate(
        places, F.struct(F.lit(-3).alias("at"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct(p.alias("at"), (a["n"] + F.least(F.lit(3), p - a["at"])).alias("n")), lambda a: a["n"])
    return F.when(last >= 1, covered).otherwise(F.lit(0).cast("long"))


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_stops) per row of `docs`
    (doc_id, text, others ignored). A null text has no words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select(F.col("doc_id").cast("long"), text.alias("text")).select(
        "doc_id", "text", F.explode(F.array(F.struct(
            F.regexp_extract_all("text", F.lit(f"({WORD})")).alias("words"),
            F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)).alias("lines")))).alias("s"))
    words, lines = F.col("s.words"), F.col("s.lines")
    return split.withColumns({"words": words, "lines": lines}).select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", _SPACES, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated(F.col("words")).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.length("text") - F.length(F.translate("text", ".!?", ""))).cast("long").alias("n_stops"))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(F.col("n_words") == 0, 0).when(bad, -1).when(good, 1).otherwise(0)


def votes() -> dict[str, Column]:
    """The rules over the columns of `features`: -1 bad, 1 good, 0 abstains. Without a word all abstain."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    symbols, repeats, mean = F.col("n_symbols") / n, F.col("n_repeat_words") / n, F.col("word_chars") / n
    lines, stops = F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)), F.col("n_stops") / n
    return {
        "symbols": _vote(symbols > 0.1, symbols <= 0.1),
        "repeats": _vote(repeats > 0.3, repeats <= 0.3),
        "lines": _vote((lines > 0.3) & (F.col("n_lines") >= 4), F.col("n_lines") >= 4),
        "mean_word": _vote((mean < 2.5) | (mean > 12), F.lit(True)),
        "stops": _vote((stops < 0.005) & (F.col("n_words") >= 4 * MIN_WORDS), F.col("n_words") >= 4 * MIN_WORDS),
    }


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> dict[tuple[int, ...], float]:
    """The posterior probability of being good per vote pattern, by EM over the patterns and their counts. Kind 0 is
    good, kind j has the defect rule j - 1 looks for. EM starts from the belief that a bad vote is mostly right. Accuracies
    are estimated freely under Beta priors: that a rule sees its own defect (SEES) and blames few good documents
    (FALSE_ALARM); what it says of other defects has a flat prior of two votes. Abstentions say nothing."""
    rules = len(patterns[0][0]) if patterns else 0
    kinds = range(rules + 1)
    weights = [PRIOR_SHARE * sum(n for vote, n in patterns if vote[j]) + 1 for j in range(rules)]
    belief = []
    for vote, _ in patterns:
        bad = [j for j in range(rules) if vote[j] < 0]
        belief.append([0.05 if bad else 0.95] + [(0.95 / len(bad) if j in bad else 0.0) if bad else 0.05 / rules for j in range(rules)])
    for _ in range(rounds):
        weight = [sum(n * b[k] for (_, n), b in zip(patterns, belief)) for k in kinds]
        total = sum(weight) + rules + 1
        blames = [[0.0] * rules for _ in kinds]  # chance of a bad vote, given that the rule votes
        for j in range(rules):
            bad, voted = [1.0] * (rules + 1), [2.0] * (rules + 1)
            for k, mean in ((0, FALSE_ALARM), (j + 1, SEES)):
                bad[k], voted[k] = weights[j] * mean, weights[j]
            for (vote, n), b in zip(patterns, belief):
                if vote[j]:
                    for k in kinds:
                        voted[k] += n * b[k]
                        bad[k] += n * b[k] * (vote[j] < 0)
            for k in kinds:
                blames[k][j] = bad[k] / voted[k]
        for i, (vote, _) in enumerate(patterns):
            logs = [math.log((weight[k] + 1) / total) + sum(math.log(blames[k][j] if v < 0 else 1 - blames[k][j])
                                                           for j, v in enumerate(vote) if v) for k in kinds]
            top = max(logs)
            raw = [math.exp(x - top) for x in logs]
            belief[i] = [x / sum(raw) for x in raw]
    return {vote: b[0] for (vote, _), b in zip(patterns, belief)}


def judge(spark: SparkSession, docs: DataFrame, keep: float = KEEP) -> DataFrame:
    """The features of every row of `docs`, its `posterior`, `base_failed` (fewer than 50 words, or more than half
    of them in repeated windows) and `kept` (false if base_failed, else posterior >= keep). Null and empty texts
    fail the base; repeated rows vote each; an empty table gives no rows."""
    rules = votes()
    seen = stored(spark, features(docs).withColumns({f"v_{k}": v for k, v in rules.items()}), "votes")
    names = [f"v_{k}" for k in rules]
    patterns = [(tuple(r[:-1]), r[-1]) for r in seen.groupBy(*names).agg(F.count("*").alias("n")).orderBy(*names).collect()]
    known = [F.when(F.array(*names) == F.array(*[F.lit(v) for v in vote]), F.lit(p)) for vote, p in estimate(patterns).items()]
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return seen.withColumn("posterior", F.coalesce(*known, F.lit(0.0))).withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= keep)).drop(*names)
