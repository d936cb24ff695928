"""The corpus pipeline: language, near duplicates, secrets, source mix, packed sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadvault.llm import langid, mixing, packing, secret_scan, simhash
from leadvault.llm.common import ship_code, stored
from leadvault.llm.queries import tokenizer_path
from leadvault.session import configure

#: Documents without a language of at least this share are rejected.
LEAST_SHARE = 1 / 3


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text is in a language of the labelled rows; texts that no learned language explains go, and so do null texts and
    texts without a letter. Where no row is labelled nothing is known about languages: all texts with a letter
    stay. Every column stays, whatever its name; an empty table stays empty."""
    ship_code(configure(spark))
    model = langid.fit(docs.where(~langid.held_out()))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return langid.accepted(docs, model, LEAST_SHARE)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest doc_id, see `keep_one`."""
    ship_code(configure(spark))
    return simhash.keep_one(spark, docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, secrets in their texts replaced; n_chars follows the text."""
    ship_code(configure(spark))
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select([F.col(f"`{c}`") for c in docs.columns]) if "n_chars" in docs.columns else clean


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, rounded to whole documents: 0 to 3 times. Texts without a word are never
    taken. Rows under one doc_id, null ids too, are taken as often as the most wanted of them. Null is a source of its
    own. Every column stays, whatever its name; an empty table stays empty."""
    configure(spark)
    _, per_doc = mixing.mix(spark, docs)
    times = per_doc.where("size > 0").select(
        F.col("doc_id").alias("id_taken"), F.round(F.col("taken") / F.col("size")).cast("int").alias("times"))
    times = times.where("times > 0").groupBy("id_taken").agg(F.max("times").alias("times"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("doc_id").cast("long").alias("id"))
    taken = whole.join(times, F.col("id").eqNullSafe(F.col("id_taken")))
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("times")))).select("doc.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as sequences of tokens, one row per piece of a document; copies of a document never share a sequence."""
    ship_code(configure(spark))
    return packing.pack_documents(spark, docs, tokenizer_path(), apart=True)


STAGES = [
    ("language ID", keep_known_languages),
    ("SimHash near-dedup", keep_one_of_near_copies),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: SQL can't express the stages; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what each returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(spark, stage(spark, docs, sf_dir), f"stage{number}")
    return docs
