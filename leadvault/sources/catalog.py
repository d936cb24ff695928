"""Tables, schemas and views in the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LAYERS = ("bronze", "silver", "gold", "seeds", "snapshots", "test_failures")


def _quoted(props: dict) -> str:
    return ", ".join(f"'{k}' = '{v}'" for k, v in props.items())


def ensure_layers(spark: SparkSession, env: str, location: str | None = None) -> list[str]:
    """Create the environment's layer databases where they are missing; returns their names."""
    names = [f"{env}_{layer}" for layer in LAYERS]
    for name in names:
        at = f" LOCATION '{location}/{name}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{at}")
    return names


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """The tables of a database, without the session's temporary views."""
    return spark.sql(f"SHOW TABLES IN {database}").filter(~F.col("isTemporary"))


def ensure_table(spark: SparkSession, name: str, schema: T.StructType | str, partition_by=(), sort_by=(),
                 properties: dict | None = None, path: str | None = None) -> None:
    """Create a parquet table from a column list if it does not exist. The sort order is kept as
    a table property, for writers to read."""
    struct = T.DataType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in struct.fields)
    props = dict(properties or {})
    if sort_by:
        props["sort_by"] = ",".join(sort_by)
    sql = f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
    if partition_by:
        sql += f" PARTITIONED BY ({', '.join(partition_by)})"
    if path:
        sql += f" LOCATION '{path}'"
    if props:
        sql += f" TBLPROPERTIES ({_quoted(props)})"
    spark.sql(sql)


def register_path(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Make existing parquet files a table, with the partitions found on disk."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def set_properties(spark: SparkSession, table: str, props: dict) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({_quoted(props)})")


def add_columns(spark: SparkSession, table: str, columns: str) -> None:
    """Add columns in place: old files read them as NULL."""
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")


def alter_columns(df: DataFrame, add: dict | None = None, drop=(), rename: dict | None = None) -> DataFrame:
    """Shape of a path dataset after adding, dropping and renaming columns; the caller rewrites it."""
    df = df.drop(*drop).withColumnsRenamed(rename or {})
    return df.withColumns({n: F.lit(None).cast(t) for n, t in (add or {}).items()})


def rename_table(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def analyze(spark: SparkSession, table: str, all_columns: bool = False) -> DataFrame:
    """Collect table (and column) statistics for the optimizer; returns the recorded facts."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS" + (" FOR ALL COLUMNS" if all_columns else ""))
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Statistics'")


def materialize(df: DataFrame, mode: str, name: str, path: str | None = None, keys=(), order_by=()) -> DataFrame:
    """Store a model as a ``view`` (lazy), a ``table`` (rebuilt) or ``incremental`` (merged by key into the dataset
    at ``path``, of which only the key partitions that the frame touches are rewritten)."""
    spark = df.sparkSession
    if mode == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if mode == "table":
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    if mode == "incremental":
        from leadvault.sources.partitions import PART, merge_partitions

        merge_partitions(spark, df, path, keys, order_by)
        return spark.read.parquet(path).drop(PART)
    raise ValueError(mode)
