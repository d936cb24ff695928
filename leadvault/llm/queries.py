"""The numbered queries: each applies its operator to its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadvault.llm import (decontaminate, langid, lemp, licences, maxscore, mixing, packing, repair, reputation, secret_scan, simhash,
                           suffix_dedup, weak_quality)
from leadvault.llm.common import ship_code
from leadvault.session import configure


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(configure(spark))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(spark, _table(spark, sf_dir, "documents"))


def op3_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(spark, _table(spark, sf_dir, "documents")).drop("kept")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, per_doc = mixing.mix(spark, _table(spark, sf_dir, "documents"))
    return per_doc.select("doc_id", "source", "size", "source_size", "target", "taken")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(spark, _table(spark, sf_dir, "documents"), tokenizer_path())


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~langid.held_out()))
    return langid.identify(docs, model).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score",
                                               F.array_join(F.array_sort(F.map_keys("proportions")), ",").alias("languages"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.secret_spans(_table(spark, sf_dir, "documents")))


#: Fixed values: the rules of the URL filter (verdict, host, path).
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def page_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(host, bad): a page's outcome is that of the labelled document whose number its path ends in: bad if of low
    quality or toxic. Pages of unlabelled documents have none; a document labelled twice is bad if ever."""
    pages, labels = _table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels")
    number = F.regexp_extract(reputation.path_of(F.col("url")), r"^/[a-z]+/([0-9]{1,18})(?:/|\.html)?$", 1)
    numbered = pages.select(reputation.host_of(F.col("url")).alias("host"), number.try_cast("long").alias("doc_id"))
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    told = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max(bad).alias("bad"))
    return numbered.join(told, "doc_id").select("host", "bad")


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reputation.judge(_table(spark, sf_dir, "pages"), URL_RULES, page_outcomes(spark, sf_dir))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_quality.judge(spark, _table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")


def op9_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.nearest(spark, _table(spark, sf_dir, "embeddings"), every=20)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(spark, _table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lemp.ranked(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_damaged(spark, _table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_mixing, op2_licences, op3_suffix, op4_packing, op5_language, op6_secrets, op7_urls, op8_quality,
                                   op9_search, op10_simhash, op11_ranked, op12_decontamination,
                                   op13_conversations)}

#: Terms of a text, null texts none.
_SQL_TERMS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")



def _repair_sql() -> str:
    """Conversations row by row: per grammar state the least (cost, audit) and the text said on the way."""
    def edit(state, cost, letter, said):
        return f"{{'c': st[{state + 1}].c + {cost}, 'a': st[{state + 1}].a || '{letter}', 't': st[{state + 1}].t || {said}}}"

    def least(*ways):
        return f"list_sort(list_filter([{', '.join(ways)}], lambda w: w IS NOT NULL))[1]"

    def when(condition, way):
        return f"CASE WHEN {condition} THEN {way} END"

    def insert(of, said):
        return f"{{'c': {of}.c + 3, 'a': {of}.a || 'I', 't': {of}.t || chr(10) || '{said}:'}}"

    kept, live = "chr(10) || role || ':' || text", "NOT dead"
    gone = [edit(k, 4, "D", "''") for k in range(4)]
    keep = lambda initial, *states: [when(f"{live} AND initial = '{initial}'", edit(k, "extra", "K", kept)) for k in states]
    rerole = lambda role, *states: [when(live, edit(k, "3 + extra", "R", f"chr(10) || '{role}:' || text")) for k in states]
    moved = [gone[0], least(gone[1], *keep("s", 0)), least(gone[2], *keep("u", 0, 1, 3), *rerole("user", 0, 1, 3)),
             least(gone[3], *keep("a", 2), *rerole("assistant", 2))]
    user = least("st[3]", insert("st[1]", "user"), insert("st[2]", "user"), insert("st[4]", "user"))
    closed = f"[st[1], st[2], u, {least('st[4]', insert('u', 'assistant'))}]"
    far = "{'c': 1000000000, 'a': '', 't': ''}"
    return rf"""
        WITH RECURSIVE bits AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
        keyed AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(list_prepend(4294967295::BIGINT,
                list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT)),
                lambda c, b: xor(t[1 + (xor(c, b) & 255)], c >> 8)), 4294967295) % 20 AS kind FROM conversations, bits),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM keyed WHERE kind <> 0),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(role || chr(0) || text), copy) AS place,
                regexp_extract(text, '([^ 	-])[ 	-]*$', 1) AS last FROM damaged),
        faulted AS (
            SELECT *, CASE WHEN last = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
                WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault, role[1] AS initial,
                lag(role[1]) OVER (PARTITION BY conv_id ORDER BY place) AS before FROM placed),
        counted AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
                count(*) FILTER (place > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM faulted GROUP BY conv_id),
        rows_ AS (
            SELECT conv_id, place, role, text, initial, fault IN ('blank', 'duplicate') AS dead,
                CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS extra FROM faulted),
        way AS (
            SELECT conv_id, 0::BIGINT AS place, [{{'c': 0, 'a': '', 't': ''}}, {far}, {{'c': 3, 'a': 'I', 't': chr(10) || 'user:'}},
                {{'c': 6, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}}] AS st FROM counted
            UNION ALL
            SELECT conv_id, place, {closed} AS st FROM (SELECT conv_id, place, st, {user} AS u FROM (
                SELECT w.conv_id, r.place, [{", ".join(moved)}] AS st
                FROM way w JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.place = w.place + 1))),
        done AS (SELECT conv_id, {least("st[1]", "st[4]")} AS w FROM way QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY place DESC) = 1)
        SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
            coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(w.c, 0)::BIGINT AS cost,
            coalesce(w.a, '') AS audit, sha256(coalesce(substr(w.t, 2), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM o.conv_id
        LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM o.conv_id"""


#: Only where SQL can express the whole result.
ORACLES = {
    "op9_search": """
        WITH v AS (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 64)::BIGINT) AS w
            FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.w::DOUBLE[], c.w::DOUBLE[])::BIGINT AS score
            FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 20 = 0),
        k AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INT AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 20""",
    "op11_ranked": rf"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_SQL_TERMS} AS terms FROM documents),
        held AS (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d),
        tf AS (SELECT r, doc_id, n, term, count(*) AS tf FROM held GROUP BY ALL),
        total AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
        asked AS (SELECT q, item_id, term, count(*) AS times FROM (
            SELECT row_number() OVER () AS q, item_id, unnest({_SQL_TERMS}) AS term FROM benchmark) GROUP BY ALL),
        part AS (
            SELECT q, item_id, r, doc_id, times * floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT
                * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))) AS added
            FROM asked JOIN df USING (term) JOIN tf USING (term) CROSS JOIN total),
        scored AS (SELECT q, item_id, r, doc_id, sum(added)::BIGINT AS score FROM part GROUP BY ALL),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank
                   FROM scored WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20""",
    "op12_decontamination": rf"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_SQL_TERMS} AS words FROM documents),
        b AS (SELECT item_id::VARCHAR AS item, {_SQL_TERMS} AS words FROM benchmark),
        wins AS (
            SELECT DISTINCT item, list_slice(words, k, k + 9) AS win
            FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 10, 0) + 2)) AS k FROM b WHERE len(words) > 0)),
        lengths AS (SELECT DISTINCT len(win) AS l FROM wins),
        grams AS (
            SELECT r, k, l, list_slice(words, k, k + l - 1) AS win
            FROM (SELECT r, words, l, unnest(range(1, len(words) - l + 2)) AS k FROM d, lengths WHERE len(words) >= l)),
        hits AS (SELECT r, k, l, item FROM grams JOIN wins USING (win)),
        covered AS (SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(k, k + l)) AS place FROM hits) GROUP BY r),
        items AS (SELECT r, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hits GROUP BY r)
        SELECT doc_id, coalesce(len(words), 0)::BIGINT AS n_words, coalesce(covered.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
            sha256(coalesce(names, '')) AS items_sha256, coalesce(covered.n, 0) > 0 AS contaminated
        FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)""",
    "op13_conversations": _repair_sql(),
}
