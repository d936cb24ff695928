"""Readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadvault.operators.rows import compute_once
from leadvault.sources.schemas import ANSWERS, Stream

#: Holds the text of objects that don't fit their declared schema.
CORRUPT = "_corrupt"


def scan_bronze(spark: SparkSession, path: str, schema: T.StructType | None = None,
                start_date: str | None = None, date_col: str = "_load_date") -> DataFrame:
    """Raw table from a start load date on. The bound is a literal on a stored column, so it
    prunes partitions or parquet row groups."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    if start_date is None:
        return df
    return df.filter(F.col(date_col) >= F.lit(start_date).cast(df.schema[date_col].dataType))


def with_audit(df: DataFrame, source: str, as_of: str, record_source: str | None = None) -> DataFrame:
    """Stamp extraction time, source system, load date and record source."""
    return df.withColumns({
        "_extraction_timestamp": F.lit(as_of).cast("timestamp_ntz"),
        "_source_system": F.lit(source),
        "_load_date": F.lit(as_of).cast("date"),
        "record_source": F.lit(record_source or source),
    })


def unpack_answers(df: DataFrame, names: dict, col: str = "field_data") -> DataFrame:
    """Form answers (array of name and values, or its JSON text) to one column per wanted name.

    ``names`` maps output column to question name. The first value of the first answer counts;
    a question not answered gives NULL."""
    as_text = isinstance(df.schema[col].dataType, T.StringType)
    parsed = compute_once(df, {"_answers": F.from_json(col, ANSWERS) if as_text else F.col(col)})

    def answer(question):
        at = F.array_position("_answers.name", F.lit(question)).cast("int") - 1
        return F.get(F.get("_answers.values", at), F.lit(0))

    return parsed.select(*[c for c in df.columns if c != col],
                         *[answer(q).alias(out) for out, q in names.items()])


def read_nested(df: DataFrame, col: str, schema: str, members: dict) -> DataFrame:
    """Members of a JSON object as typed columns; ``members`` maps output column to dotted path."""
    parsed = df.withColumn("_obj", F.from_json(col, schema))
    return parsed.select(*df.columns, *[F.col(f"_obj.{path}").alias(out) for out, path in members.items()])


def read_declared(spark: SparkSession, path: str, stream: Stream, start_date: str | None = None) -> tuple[DataFrame, DataFrame]:
    """A stream's JSON objects by its declared schema, and what does not fit it.

    First: the rows, fields that were not sent NULL. Second: (column_name, value), a NULL column and the text of
    every object that is cut or holds another type than declared; nothing of it is among the rows."""
    schema = T.StructType([*stream.schema, T.StructField(CORRUPT, T.StringType())])
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = compute_once(lines, {"_row": F.from_json("value", schema, {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"})})
    fits = F.col(f"_row.{CORRUPT}").isNull()
    rows = parsed.filter(fits).select("_row.*").drop(CORRUPT)
    if start_date is not None:
        rows = rows.filter(F.col("_load_date") >= start_date)
    return rows, parsed.filter(~fits).select(F.lit(None).cast("string").alias("column_name"), "value")


def cast_declared(df: DataFrame, types: dict, key=()) -> tuple[DataFrame, DataFrame]:
    """Columns cast to types, and the values that the casts lose.

    First: all rows; a malformed value is NULL. Second: (*key, column_name, value) for each such value, whose text is kept;
    absent values are none. One pass over the rows finds those of all columns."""
    cast = df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})
    lost = F.array_compact(F.array(*[F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.struct(
        F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))) for c, t in types.items()]))
    return cast, df.select(*key, F.inline(lost))


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table or temporary view by name, or a parquet folder by path."""
    return spark.read.parquet(name_or_path) if "/" in name_or_path else spark.table(name_or_path)


def read_jdbc(spark: SparkSession, url: str, table: str, key: str | None = None, lower: int | None = None,
              upper: int | None = None, partitions: int = 16, properties: dict | None = None) -> DataFrame:
    """Relational table. With a numeric key and its bounds the read is split into parallel ranges;
    rows outside the bounds fall into the first and last range."""
    props = properties or {}
    if key is None:
        return spark.read.jdbc(url, table, properties=props)
    return spark.read.jdbc(url, table, column=key, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=props)


def load_seed(spark: SparkSession, path: str, schema) -> DataFrame:
    """Reference data from CSV with a header and a declared schema; malformed rows fail the load."""
    return spark.read.schema(schema).csv(path, header=True, mode="FAILFAST")


def list_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """One row per file below a folder: path, size and modification time. The file content is
    not selected, so it is not read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
             .option("recursiveFileLookup", "true").load(path))
    return files.select(
        F.col("path").alias("file_path"), F.col("length").alias("file_size"),
        F.col("modificationTime").cast("timestamp_ntz").alias("modified_at"))
