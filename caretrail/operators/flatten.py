"""Flattening tall observations to one row per event."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretrail.functions.obs import SEPARATOR

SLOTS = ("value_coded", "value_numeric", "value_datetime", "value_complex", "value_text", "value_drug", "value_modifier")


def typed_value(df: DataFrame, slots: Iterable[str] = SLOTS) -> Column:
    """The one filled value slot as text. Dates lose their time, whole numbers their fraction."""
    present = []
    for name in slots:
        if name not in df.columns:
            continue
        column = F.col(name)
        kind = dict(df.dtypes)[name]
        if kind.startswith("timestamp"):
            column = F.to_date(column)
        if kind in ("double", "float") or kind.startswith("decimal"):
            whole = column == F.floor(column)
            column = F.when(whole, column.cast("bigint").cast("string")).otherwise(column.cast("string"))
        present.append(column.cast("string"))
    return F.coalesce(*present)


def token(*parts: Column) -> Column:
    """`!!a=b!!`"""
    return F.concat(F.lit("!!"), F.concat_ws("=", *[p.cast("string") for p in parts]), F.lit("!!"))


def ordered_text(order: list[Column], text: Column, distinct: bool = False, separator: str = SEPARATOR) -> Column:
    """Aggregate: texts of a group joined in a fixed order."""
    item = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)], text.alias("text"))
    items = F.collect_set(item) if distinct else F.collect_list(item)
    return F.array_join(F.transform(F.array_sort(items), lambda s: s["text"]), separator)


def flatten(
    obs: DataFrame,
    key: list[str],
    concepts: Iterable[int] | None = None,
    date: str = "obs_date",
    distinct: bool = False,
    marks: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per key with the encoded observations, their dates and optional extra aggregates.

    The concept filter is applied before the shuffle, so it reaches the scan. Ties of concept and code are put in
    value order, which makes the text a function of the group.
    """
    if concepts is not None:
        obs = obs.filter(F.col("concept_id").isin(list(concepts)))
    value = typed_value(obs)
    keep = obs.withColumn("__value", value).filter(F.col("__value").isNotNull())
    coded = F.coalesce(F.col("value_coded"), F.lit(-1)) if "value_coded" in obs.columns else F.lit(-1)
    order = [F.col("concept_id"), coded, F.col("__value")]
    return keep.groupBy(*key).agg(
        ordered_text(order, token(F.col("concept_id"), F.col("__value")), distinct).alias("obs"),
        ordered_text(order, token(F.col("concept_id"), F.col(date)), distinct).alias("obs_datetimes"),
        *[c.alias(n) for n, c in (marks or {}).items()],
    )


def answer_map(obs: DataFrame, key: list[str], concepts: Iterable[int] | None = None, date: str = "obs_date") -> DataFrame:
    """One row per key with `answers`, a map from concept to its dated values.

    `obs` has concept_id and value (text). Repeated answers stay, as they do in the encoded text.
    """
    if concepts is not None:
        obs = obs.filter(F.col("concept_id").isin(list(concepts)))
    return (
        obs.filter(F.col("value").isNotNull())
        .groupBy(*key)
        .agg(F.collect_list(F.struct("concept_id", "value", F.col(date).alias("date"))).alias("__a"))
        .select(*key, _by_concept(F.array_sort("__a")).alias("answers"))
    )


def _by_concept(entries: Column) -> Column:
    concepts = F.array_distinct(F.transform(entries, lambda e: e["concept_id"]))
    values = F.transform(
        concepts,
        lambda c: F.transform(
            F.filter(entries, lambda e: e["concept_id"] == c), lambda e: F.struct(e["value"].alias("value"), e["date"].alias("date"))
        ),
    )
    return F.map_from_arrays(concepts, values)


def flatten_without_encounter(obs: DataFrame) -> DataFrame:
    """Observations that belong to no encounter, one row per person and time, with a key above all encounter ids."""
    return flatten(
        obs,
        ["person_id", "obs_datetime"],
        date="obs_date",
        marks={"encounter_id": F.min("obs_id") + F.lit(100_000_000)},
    ).select(
        "encounter_id",
        "person_id",
        F.col("obs_datetime").alias("encounter_datetime"),
        F.lit(99999).alias("encounter_type"),
        F.lit(None).cast("int").alias("location_id"),
        (-F.col("encounter_id")).alias("visit_id"),
        "obs",
        "obs_datetimes",
    )


def visit_or_own(visit_id: Column, encounter_id: Column) -> Column:
    """Visit id, or for an event without one a key no visit can have."""
    return F.coalesce(visit_id, -encounter_id)


def flatten_orders(orders: DataFrame) -> DataFrame:
    """One row per encounter with its ordered concepts and their dates."""
    order = [F.col("concept_id"), F.col("date_activated")]
    return orders.groupBy("encounter_id", "person_id").agg(
        ordered_text(order, F.col("concept_id").cast("string")).alias("orders"),
        ordered_text(order, token(F.col("concept_id"), F.col("date_activated"))).alias("order_datetimes"),
        F.array_sort(F.collect_set("concept_id")).alias("order_concepts"),
    )


def flatten_groups(obs: DataFrame, parents: Iterable, group: str = "obs_group_id", key: str = "encounter_id") -> DataFrame:
    """Observation groups: children joined per parent, then parents per event with ` $ `."""
    children = obs.filter(F.col("group_concept").isin(list(parents))).withColumn("__value", typed_value(obs))
    children = children.filter(F.col("__value").isNotNull())
    per_group = children.groupBy(key, group).agg(
        ordered_text([F.col("concept_id"), F.col("__value")], token(F.col("concept_id"), F.col("__value"))).alias("part")
    )
    return per_group.groupBy(key).agg(ordered_text([F.col(group)], F.col("part"), separator=" $ ").alias("obs_groups"))


def pivot_first(obs: DataFrame, key: list[str], columns: dict[str, int], value: Column) -> DataFrame:
    """One column per concept holding its least value: plain partial aggregation, no pivot job."""
    obs = obs.filter(F.col("concept_id").isin(list(columns.values())))
    return obs.groupBy(*key).agg(*[F.min(F.when(F.col("concept_id") == c, value)).alias(n) for n, c in columns.items()])


def pivot_all(obs: DataFrame, key: list[str], columns: dict[str, int], value: Column, separator: str = " // ") -> DataFrame:
    """One column per concept holding all its values in order."""
    obs = obs.filter(F.col("concept_id").isin(list(columns.values())))
    return obs.groupBy(*key).agg(
        *[
            F.nullif(
                F.array_join(F.array_sort(F.collect_list(F.when(F.col("concept_id") == c, value))), separator), F.lit("")
            ).alias(n)
            for n, c in columns.items()
        ]
    )


def transpose_numbered(df: DataFrame, key: list[str], value: Column, order: list[Column], prefix: str, width: int) -> DataFrame:
    """Long to wide with numbered columns: the n-th distinct value of each key. A rest column keeps what is beyond."""
    items = F.array_sort(F.collect_set(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)], value.alias("v"))))
    wide = df.groupBy(*key).agg(items.alias("__i"))
    return wide.select(
        *key,
        *[F.get(F.col("__i"), F.lit(i))["v"].alias(f"{prefix}{i + 1}") for i in range(width)],
        F.when(
            F.size("__i") > width,
            F.array_join(F.transform(F.slice("__i", F.lit(width + 1), F.size("__i")), lambda s: s["v"].cast("string")), SEPARATOR),
        ).alias(f"{prefix}rest"),
    )
