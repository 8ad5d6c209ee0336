"""Names of kept columns beside those of results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def beside(keep: Sequence[str], results: Sequence[str]) -> list[str]:
    """Names for the kept columns so that none has the name of a result or of another: `_in` is added until one is free.

    Names are held apart as Spark does, without regard to case.
    """
    taken, out = {r.lower() for r in results}, []
    for name in keep:
        while name.lower() in taken:
            name += "_in"
        taken.add(name.lower())
        out.append(name)
    return out


def laid_out(df: DataFrame, keep: Sequence[str], value: Column, results: StructType) -> tuple[DataFrame, StructType]:
    """The kept columns and the value by position, and the schema of kept columns and results."""
    schema = StructType()
    kept = df.select(*keep).schema
    for name, field in zip(beside(keep, results.names), kept, strict=True):
        schema.add(name, field.dataType)
    for field in results:
        schema.add(field)
    return df.select(*[F.col(k).alias(f"c{i}") for i, k in enumerate(keep)], value.alias(f"c{len(keep)}")), schema
