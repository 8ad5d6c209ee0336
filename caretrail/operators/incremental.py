"""Incremental recompute: which keys changed, what else that touches, and rebuilding exactly those.

Changes are found per source by its own change times and united as a set of person keys; persons whose rows read those of a
changed person are added until none is left to add. A dataset is recomputed for the set from the sources, so voided, moved and late
rows need no special case, and then replaces the old rows of the set. Datasets that are built from others follow in order.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretrail.session import cut_lineage
from caretrail.sources.datasets import BEGINNING, Datasets
from caretrail.sources.sinks import replace_keys
from caretrail.sources.tables import Tables

# The change times of each source.
CHANGE_TIMES = {
    "encounter": ["date_created", "date_changed", "date_voided"],
    "obs": ["date_created", "date_changed", "date_voided"],
    "lab_event": ["date_created", "date_changed"],
    "clinical_order": ["date_activated", "date_changed"],
    "person": ["date_changed", "date_voided"],
}


def _moment(value: str | date | datetime | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def changed_since(df: DataFrame, mark: str | date | Column, columns: Sequence[str], key: str = "person_id", until: str | date | Column | None = None) -> DataFrame:
    """Keys of rows created, changed or voided at or after the mark, and before `until` (whichever of the times the source has)."""
    test = F.lit(False)
    for name in columns:
        # The mark takes the type of the time, so that the filter can reach the scan.
        kind = df.schema[name].dataType
        inside = F.col(name) >= _moment(mark).cast(kind)
        if until is not None:
            inside = inside & (F.col(name) < _moment(until).cast(kind))
        test = test | F.coalesce(inside, F.lit(False))
    return df.filter(test).select(F.col(key).alias("person_id")).distinct()


def changed_persons(t: Tables, mark: str | date, until: str | date | None = None, sources: Sequence[str] = tuple(CHANGE_TIMES)) -> DataFrame:
    """Persons with rows of any source created, changed or voided since the mark, late laboratory results and the person's own row among them.

    What counts is when a row changed, not the day it is about: an old observation that is corrected today is found.
    """
    out = None
    for name in sources:
        keys = changed_since(getattr(t, name), mark, CHANGE_TIMES[name], until=until)
        out = keys if out is None else out.unionByName(keys)
    return out.distinct()


def with_dependents(keys: DataFrame, edges: DataFrame, source: str = "person_a", target: str = "person_b", key: str = "person_id") -> DataFrame:
    """The keys and all that can be reached from them over edges, from `source` to `target`.

    Each round follows the edges of the keys added last, and ends when none is new; there are as many rounds as the longest way has edges.
    """
    edges = edges.select(F.col(source).alias("__from"), F.col(target).alias(key)).where("__from IS NOT NULL").distinct()
    added = known = cut_lineage(keys.select(key).distinct())
    while True:
        reached = added.withColumnRenamed(key, "__from").join(edges, "__from").select(key).distinct()
        added = cut_lineage(reached.join(known, key, "left_anti"))
        if added.isEmpty():
            return known
        known = known.unionByName(added)


def recompute(old: DataFrame, keys: DataFrame, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The dataset with the rows of the given persons rebuilt; persons that have no rows any more lose theirs."""
    return replace_keys(old, build(keys).select(*old.columns), keys, ["person_id"])


@dataclass(frozen=True)
class Step:
    """A dataset of a graph: its key, how it is built for some keys (None: all), and what it reads.

    `reads` maps the name of another dataset of the graph to a function from that dataset's rows to the keys of this one that they bear on.
    `sources(since, until)` gives the keys that changes in the sources bear on directly.
    """

    name: str
    key: tuple[str, ...]
    build: Callable[[DataFrame | None], DataFrame]
    reads: dict[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)
    sources: Callable[[datetime, datetime], DataFrame] | None = None


def cascade(store: Datasets, steps: list[Step], until: datetime, fallback: datetime = BEGINNING) -> dict[str, int]:
    """Bring all datasets of a graph up to a moment, each after those it reads; returns the keys rebuilt of each.

    A dataset hands on the rows it had of its changed keys and those it has now: what either bears on is changed in its dependents. So a
    visit that moves to another month changes both months. Keys and handed rows are written once, before anything is replaced.
    """
    by_name, rebuilt = {s.name: s for s in steps}, {}
    if unknown := {r for s in steps for r in s.reads} - set(by_name):
        raise ValueError(f"unknown datasets {sorted(unknown)}")
    passed: dict[str, list[DataFrame]] = {s.name: [] for s in steps}
    for name in TopologicalSorter({s.name: set(s.reads) for s in steps}).static_order():
        step, start = by_name[name], time.monotonic()
        since, run = store.mark(name, fallback), until.isoformat()
        first = not store.exists(name)
        keys = None
        if not first:
            parts = [*passed[name], *([step.sources(since, until)] if step.sources else [])]
            keys = None if not parts else parts[0].select(*step.key)
            for part in parts[1:]:
                keys = keys.unionByName(part.select(*step.key))
            if keys is None:
                rebuilt[name] = 0
                continue
            keys = cut_lineage(keys.distinct())
        dependents = [(s, s.reads[name]) for s in steps if name in s.reads]
        before = [] if first else [cut_lineage(bears(_rows(store, step, keys)).select(*s.key).distinct()) for s, bears in dependents]
        rows = store.create(name, step.build(None), step.key) if first else store.replace(name, keys, step.build(keys), step.key)
        rebuilt[name] = (store.read(name).select(*step.key).distinct() if first else keys).count()
        for i, (s, bears) in enumerate(dependents):
            now = store.read(name) if first else _rows(store, step, keys)
            passed[s.name] += [*before[i : i + 1], bears(now).select(*s.key).distinct()]
        store.log(name, run, since, until, time.monotonic() - start, rows)
    return rebuilt


def _rows(store: Datasets, step: Step, keys: DataFrame) -> DataFrame:
    return store.read(step.name).join(keys, list(step.key), "left_semi")


def changed_encounters(t: Tables, mark: str) -> DataFrame:
    """Encounters created, voided or changed since the mark; each source row says which of them it was."""
    since = F.lit(mark).cast("date")
    enc = t.encounter
    created, voided, changed = [F.col(n) >= since for n in ("date_created", "date_voided", "date_changed")]
    why = F.when(created, "created").when(voided, "voided").when(changed, "changed")
    return enc.select("encounter_id", "person_id", why.alias("change")).filter("change IS NOT NULL")
