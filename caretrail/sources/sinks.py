"""Upserts and deletes by key, output schemas, and delimited exports; stored datasets are in `datasets`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of `new`, and those of `old` whose key is not in `new`."""
    return old.join(new.select(*key), key, "left_anti").unionByName(new)


def replace_keys(old: DataFrame, new: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Old rows of the given keys go, whether or not they come back in `new`."""
    return old.join(keys.select(*on), on, "left_anti").unionByName(new)


def delete_keys(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return df.join(keys.select(*on), on, "left_anti")


def insert_ignore(keys: DataFrame, more: DataFrame, on: list[str]) -> DataFrame:
    """Key set with new members added; existing rows win."""
    return keys.unionByName(more.dropDuplicates(on).join(keys.select(*on), on, "left_anti"))


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The frame in the column order and types of an output table; an error for missing or unknown columns."""
    missing = [f.name for f in schema if f.name not in df.columns]
    unknown = [c for c in df.columns if c not in schema.fieldNames()]
    if missing or unknown:
        raise ValueError(f"missing columns {missing}, unknown columns {unknown}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def export_delimited(df: DataFrame, path: str) -> None:
    """Quoted comma-separated files, one per partition."""
    df.write.mode("errorifexists").option("quoteAll", True).option("header", True).csv(path)


def delimited_lines(df: DataFrame) -> DataFrame:
    """The lines such an export holds."""
    return df.select(F.to_csv(F.struct(*[F.col(c).cast("string") for c in df.columns]), {"quoteAll": "true"}).alias("line"))


def read_delimited(spark: SparkSession, path: str, schema: str | None = None, header: bool = True, sampled: float = 1.0, **options) -> DataFrame:
    """Delimited files. Without a schema the types are inferred, from a share of the lines if one is given. Only columns that are used are parsed."""
    reader = spark.read.options(header=header, **options)
    return (reader.schema(schema) if schema else reader.options(inferSchema=True, samplingRatio=sampled)).csv(path)


REJECTED = "rejected_line"


def load_delimited(spark: SparkSession, path: str, into: str, schema: str, header: bool = False, **options) -> tuple[DataFrame, DataFrame]:
    """Load delimited files into a table: its rows, and the lines that do not fit the schema, as they are.

    All columns of a line are parsed and the outcome is stored once, as Spark cannot tell a bad line from the columns that a later query picks.
    """
    lines = read_delimited(spark, path, f"{schema}, {REJECTED} string", header, mode="PERMISSIVE", columnNameOfCorruptRecord=REJECTED, **options)
    lines.write.mode("errorifexists").parquet(into)
    stored = spark.read.parquet(into)
    return stored.filter(F.col(REJECTED).isNull()).drop(REJECTED), stored.filter(F.col(REJECTED).isNotNull()).select(REJECTED)
