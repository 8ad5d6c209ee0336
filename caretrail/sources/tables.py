"""Readers for the source tables and the record-shaped views on them."""

from __future__ import annotations

import datetime as dt
import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from caretrail.operators.timeline import hot_keys, spread
from caretrail.sources.views import BASE, VIEWS, answer_rows_sql

_SCHEMA_MEMO: dict[tuple[str, str], StructType] = {}
_SPAN_MEMO: dict[tuple[str, str], tuple] = {}
_HOT_MEMO: dict[tuple[str, str, str], list] = {}
_COUNT_MEMO: dict[tuple[str, str, str], int] = {}

# Rows of a source table that one task walks, on average.
VISITS_PER_TASK, ANSWERS_PER_TASK = 25_000, 100_000


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """Delimited file with a given schema: no inference pass over the data."""
    return spark.read.schema(schema).option("header", header).option("mode", "FAILFAST").csv(path)


def read_jdbc(
    spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int, partitions: int, **options: str
) -> DataFrame:
    """Source-database table read in key ranges, one task per range."""
    reader = spark.read.format("jdbc").options(
        url=url,
        dbtable=table,
        partitionColumn=column,
        lowerBound=str(lower),
        upperBound=str(upper),
        numPartitions=str(partitions),
        fetchsize="10000",
    )
    return reader.options(**options).load()


class Tables:
    """The source tables of one data folder, each built once and pruned by the query that uses it."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        """A source table. Its schema is read from a file footer once, not for every use."""
        path = f"{self.folder}/{name}.parquet"
        memo = (self.spark.sparkContext.applicationId, path)
        if memo not in _SCHEMA_MEMO:
            _SCHEMA_MEMO[memo] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMA_MEMO[memo]).parquet(path)

    def _sql(self, text: str, base: list[str]) -> DataFrame:
        frames = {f"src_{b}": self.raw(b) for b in base}
        if {"lineitem", "orders"} <= set(base):
            # What is joined and summed up by visit stays in the partitions of this exchange, and gets far wider than its bytes tell.
            frames["src_lineitem"] = spread(frames["src_lineitem"], self.tasks("lineitem", ANSWERS_PER_TASK), "l_orderkey")
        for b in base:
            text = _name_source(text, b)
        return self.spark.sql(text, **frames)

    def view(self, name: str) -> DataFrame:
        return self._sql(VIEWS[name], BASE[name])

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            return self.view(name)
        raise AttributeError(name)

    def horizon(self, unit: str) -> tuple[str, str]:
        """First day of the encounters, and the end of the last period (month, week or day) that has one."""
        memo = (self.spark.sparkContext.applicationId, self.folder)
        if memo not in _SPAN_MEMO:
            _SPAN_MEMO[memo] = self.encounter.agg(F.min("encounter_date"), F.max("encounter_date")).first()
        first, last = (d or dt.date(1900, 1, 1) for d in _SPAN_MEMO[memo])
        end = {
            "month": (last.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1),
            "week": last + dt.timedelta(days=(5 - last.weekday()) % 7),
            "day": last,
        }[unit]
        return str(first), str(end)

    def count(self, name: str) -> int:
        """Rows of a source table; for parquet read from the footers."""
        memo = (self.spark.sparkContext.applicationId, self.folder, name)
        if memo not in _COUNT_MEMO:
            _COUNT_MEMO[memo] = self.raw(name).count()
        return _COUNT_MEMO[memo]

    def tasks(self, name: str = "orders", rows: int = VISITS_PER_TASK) -> int | None:
        """As many tasks as keep a task's share of a table at `rows`; None where the table is so small that Spark's own number does."""
        needed = -(-self.count(name) // int(self.spark.conf.get("caretrail.task.rows", str(rows))))
        return needed if needed > self.spark.sparkContext.defaultParallelism else None

    def answers(self, questions: list[tuple[int, str, int]]) -> DataFrame:
        return self._sql(answer_rows_sql(questions), ["lineitem", "orders"])

    @cached_property
    def hot_persons(self) -> list:
        """Persons whose encounters would swamp one task; found once per data folder from one pruned column."""
        return self._hot("orders", "o_custkey")

    @cached_property
    def hot_lab_persons(self) -> list:
        return self._hot("events", "user_id")

    def _hot(self, table: str, column: str) -> list:
        memo = (self.spark.sparkContext.applicationId, self.folder, table)
        if memo not in _HOT_MEMO:
            _HOT_MEMO[memo] = hot_keys(self.raw(table).select(column), column)
        return _HOT_MEMO[memo]


def _name_source(text: str, table: str) -> str:
    return re.sub(rf"\b(FROM|JOIN)\s+{table}\b", rf"\1 {{src_{table}}}", text)


def live(df: DataFrame) -> DataFrame:
    """Rows that were not soft-deleted."""
    return df.filter(F.col("voided") == 0)
