"""State carried along a person's ordered timeline.

A timeline step names the columns it adds as *looks*: what to read (previous row, last known value, first event,
running total ...) and over which rows. All looks of a step share one partitioning and one or two sort orders, so
Catalyst plans one exchange for a whole chain of steps.

A person with so many rows that one task could not walk them is handled in blocks: looks are evaluated inside
(person, block), one summary row per block is carried across the person's blocks, and the carried part is joined back.
Nothing is dropped and no task sees the whole person. `by_timeline` picks the path per person.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caretrail.session import cut_lineage

ORDER = ("encounter_date", "day_rank", "encounter_datetime", "encounter_id")


@dataclass(frozen=True)
class Look:
    kind: str  # lag | lead | last | first | next | ahead | sum | max | min
    value: Column  # the value read; null means "nothing here" for all kinds but lag and lead
    here: bool = True  # whether the current row takes part
    boxed: bool = False  # value is struct(v): a null v is a real value


def prev(value: Column) -> Look:
    """Value on the previous row of the person."""
    return Look("lag", value)


def following(value: Column) -> Look:
    """Value on the next row of the person."""
    return Look("lead", value)


def locf(value: Column) -> Look:
    """Last non-null value up to and including this row."""
    return Look("last", value)


def carry(event: Column, value: Column) -> Look:
    """Value set by the last event up to this row; an event may set it to null, which then stays."""
    return Look("last", F.when(event, F.struct(value.alias("v"))), boxed=True)


def latch(event: Column, value: Column) -> Look:
    """Value set by the first event; later events do not change it."""
    return Look("first", F.when(event, F.struct(value.alias("v"))), boxed=True)


def prev_where(event: Column, value: Column) -> Look:
    """Value on the nearest earlier row that meets a condition."""
    return Look("last", F.when(event, F.struct(value.alias("v"))), here=False, boxed=True)


def next_where(event: Column, value: Column) -> Look:
    """Value on the nearest later row that meets a condition."""
    return Look("next", F.when(event, F.struct(value.alias("v"))), here=False, boxed=True)


def running(value: Column) -> Look:
    """Running sum up to this row; nulls count as nothing."""
    return Look("sum", value)


def ever(flag: Column) -> Look:
    """1 from the first row that meets the condition on, 0 before."""
    return Look("max", F.when(flag, 1).otherwise(0))


def latest_max(value: Column) -> Look:
    return Look("max", value)


def max_ahead(value: Column) -> Look:
    """Greatest value on this row or a later one."""
    return Look("ahead", value)


BACKWARD = ("next", "ahead")


class Timeline:
    """Evaluates looks over rows keyed by `key` and ordered by `order` (a total order)."""

    def __init__(self, key: Sequence[str] = ("person_id",), order: Sequence[str] = ORDER, block: str | None = None):
        self.key, self.order, self.block = list(key), list(order), block

    def scan(self, df: DataFrame, **looks: Look) -> DataFrame:
        return self._blocked(df, looks) if self.block else self._plain(df, looks, self.key)

    # one partition per key

    def _plain(self, df: DataFrame, looks: dict[str, Look], key: list[str]) -> DataFrame:
        return df.select("*", *[self._over(look, key).alias(name) for name, look in looks.items()])

    def _over(self, look: Look, key: list[str]) -> Column:
        ahead = Window.partitionBy(*key).orderBy(*self.order)
        if look.kind == "lag":
            return F.lag(look.value).over(ahead)
        if look.kind == "lead":
            return F.lead(look.value).over(ahead)
        window = ahead
        if look.kind in BACKWARD:
            # Walk backwards: a frame that grows from one end is linear, one that shrinks is not.
            window = Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in self.order])
        window = window.rowsBetween(Window.unboundedPreceding, 0 if look.here else -1)
        out = _pick(look)(look.value).over(window)
        return out["v"] if look.boxed else out

    # one partition per (key, block), and a small one over the blocks of a key

    def _blocked(self, df: DataFrame, looks: dict[str, Look]) -> DataFrame:
        # The rows are read twice, for the blocks and for the rows themselves. Without a cut, every scan of a chain
        # would double the plan of the ones before it.
        df = cut_lineage(df)
        parts = self.key + [self.block]
        at = F.struct(*[F.col(c) for c in self.order])
        looks = {name: _as_carried(look) for name, look in looks.items()}
        inside = df
        summary = []
        for i, (name, look) in enumerate(looks.items()):
            window = Window.partitionBy(*parts).orderBy(*self.order)
            if look.kind in BACKWARD:
                window = Window.partitionBy(*parts).orderBy(*[F.col(c).desc() for c in self.order])
            window = window.rowsBetween(Window.unboundedPreceding, 0 if look.here else -1)
            inside = inside.withColumn(f"__in{i}", _pick(look)(look.value).over(window))
            known = F.when(look.value.isNotNull(), at)
            summary.append(
                {
                    "last": F.max_by(look.value, known),
                    "first": F.min_by(look.value, known),
                    "next": F.min_by(look.value, known),
                    "sum": F.sum(look.value),
                    "max": F.max(look.value),
                    "ahead": F.max(look.value),
                    "min": F.min(look.value),
                }[look.kind].alias(f"__s{i}")
            )
        blocks = df.groupBy(*parts).agg(*summary)
        carried = []
        for i, look in enumerate(looks.values()):
            window = Window.partitionBy(*self.key).orderBy(
                F.col(self.block).desc() if look.kind in BACKWARD else F.col(self.block)
            )
            window = window.rowsBetween(Window.unboundedPreceding, -1)
            carried.append(_pick(look)(F.col(f"__s{i}")).over(window).alias(f"__c{i}"))
        # A key may be null (events without a programme form a timeline too), so the join is null-safe.
        carries = blocks.select(*[F.col(p).alias(f"__p{i}") for i, p in enumerate(parts)], *carried)
        same = [F.col(p).eqNullSafe(F.col(f"__p{i}")) for i, p in enumerate(parts)]
        joined = inside.join(carries, same, "left")
        for i, (name, look) in enumerate(looks.items()):
            here, before = F.col(f"__in{i}"), F.col(f"__c{i}")
            both = {
                "last": F.coalesce(here, before),
                "next": F.coalesce(here, before),
                "first": F.coalesce(before, here),
                "sum": F.when(here.isNotNull() | before.isNotNull(), F.coalesce(here, 0 * before) + F.coalesce(before, 0 * here)),
                "max": F.greatest(here, before),
                "ahead": F.greatest(here, before),
                "min": F.least(here, before),
            }[look.kind]
            joined = joined.withColumn(name, both["v"] if look.boxed else both)
        return joined.select(*df.columns, *looks)


def _pick(look: Look) -> Callable[[Column], Column]:
    return {
        "last": lambda c: F.last(c, ignorenulls=True),
        "next": lambda c: F.last(c, ignorenulls=True),
        "first": lambda c: F.first(c, ignorenulls=True),
        "sum": F.sum,
        "max": F.max,
        "ahead": F.max,
        "min": F.min,
    }[look.kind]


def _as_carried(look: Look) -> Look:
    """One-row offsets as carries: the last box before this row, or the nearest one after it."""
    if look.kind in ("lag", "lead"):
        return Look("last" if look.kind == "lag" else "next", F.struct(look.value.alias("v")), here=False, boxed=True)
    return look


def hot_keys(df: DataFrame, key: str, rows: int | None = None) -> list:
    """All keys with more rows than one task should walk.

    The count is combined map-side. There are fewer such keys than rows of the table divided by `rows`: at the default of two
    million, half a million for a table of 10^12 rows.
    """
    if rows is None:
        rows = int(df.sparkSession.conf.get("caretrail.hot.rows", "2000000"))
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).count().filter(F.col("count") > rows)
    return [r[0] for r in counts.select(key).collect()]


def spread(df: DataFrame, tasks: int | None, *key: str) -> DataFrame:
    """Rows dealt by key to a number of tasks that grows with the input.

    Spark merges partitions by the bytes that were shuffled. Rows that later steps widen or multiply would pile up in a few tasks; a given
    number of partitions is not merged.
    """
    return df if tasks is None else df.repartition(tasks, *key)


def by_timeline(
    df: DataFrame,
    build: Callable[[DataFrame, Timeline], DataFrame],
    hot: Sequence = (),
    key: Sequence[str] = ("person_id",),
    order: Sequence[str] = ORDER,
    block: str | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Run a chain of timeline steps, with hot keys walked in blocks of the leading order column; `tasks` share the other keys."""
    if not hot:
        return build(spread(df, tasks, *key), Timeline(key, order))
    # As many keys as hot_keys promises at most, so they go to every task as a table, not as a literal list.
    keys = F.broadcast(df.sparkSession.createDataFrame([(k,) for k in hot], df.select(key[0]).schema))
    usual = build(spread(df.join(keys, key[0], "left_anti"), tasks, *key), Timeline(key, order))
    split = build(df.join(keys, key[0], "left_semi"), Timeline(key, order, block or order[0]))
    return usual.unionByName(split)


class Passes:
    """Looks that depend on one another, arranged in as few scans as their depth allows.

    Pass n may use columns and looks of the passes before it. Wide rows cost a copy per scan, so independent chains are
    laid side by side instead of one after the other.
    """

    def __init__(self) -> None:
        self.columns: dict[int, dict[str, Column]] = {}
        self.looks: dict[int, dict[str, Look]] = {}
        self.helpers: list[str] = []

    def column(self, at: int, name: str, value: Column, helper: bool = False) -> None:
        """A plain column available from pass `at` on."""
        self.columns.setdefault(at, {})[name] = value
        if helper:
            self.helpers.append(name)

    def look(self, at: int, **looks: Look) -> None:
        self.looks.setdefault(at, {}).update(looks)

    def helper(self, at: int, name: str, look: Look) -> None:
        self.looks.setdefault(at, {})[name] = look
        self.helpers.append(name)

    def set_or_soft(
        self, at: int, name: str, sets: Column, value: Column, soft: Column, soft_value: Column, clears: Column | None = None
    ) -> None:
        """A value that hard events set and clear, and that soft events set only while it is empty; ready after 3 passes.

        Hard events cut the timeline into segments. A segment that opens with a value keeps it; in one that does not,
        the first soft event counts.
        """
        hard = sets if clears is None else sets | clears
        h, v, s, g, last, p = [f"__{k}_{name}" for k in "hvsglp"]
        self.column(at, h, F.when(hard, 1).otherwise(0), True)
        self.column(at, v, F.when(sets, value), True)
        self.column(at, s, F.when(soft & ~hard, soft_value), True)
        self.helper(at, g, running(F.col(h)))
        self.helper(at, last, carry(F.col(h) == 1, F.col(v)))
        self.helper(at + 1, p, prev_where(F.col(s).isNotNull(), F.col(g)))
        first_soft = F.col(s).isNotNull() & ~F.col(p).eqNullSafe(F.col(g)) & F.col(last).isNull()
        is_hard = F.col(h) == 1
        self.look(at + 2, **{name: carry(is_hard | first_soft, F.when(is_hard, F.col(v)).otherwise(F.col(s)))})

    def last_results(self, at: int, name: str, has: Column, value: Column, date: Column, depth: int) -> None:
        """Shift register: the last `depth` results known on each row, newest first; ready after 2 * depth - 1 passes."""
        flag, result = f"__has_{name}", f"__r_{name}"
        self.column(at, flag, has, True)
        self.column(at, result, F.struct(value.alias("value"), date.alias("date")), True)
        source = result
        for i in range(1, depth + 1):
            known, before = f"__k{i}_{name}", f"__b{i}_{name}"
            self.helper(at, known, carry(F.col(flag), F.col(source)))
            if i < depth:
                self.helper(at + 1, before, prev(F.col(known)))
            self.column(at + 1, f"{name}_{i}", F.col(f"{known}.value"))
            self.column(at + 1, f"{name}_{i}_date", F.col(f"{known}.date"))
            source, at = before, at + 2

    def run(self, line: Timeline, df: DataFrame, through: int | None = None, start: int = 0) -> DataFrame:
        """Run passes start..through and drop the helpers when the last one is done."""
        last = max([*self.columns, *self.looks])
        end = last if through is None else through
        for at in range(start, end + 1):
            new = self.columns.get(at, {})
            if new:
                df = df.select("*", *[v.alias(k) for k, v in new.items()])
            if self.looks.get(at):
                df = line.scan(df, **self.looks[at])
        return df.drop(*self.helpers) if end == last else df


def last_results(df: DataFrame, line: Timeline, has: Column, value: Column, date: Column, name: str, depth: int) -> DataFrame:
    passes = Passes()
    passes.last_results(0, name, has, value, date, depth)
    return passes.run(line, df)


def pack(df: DataFrame, names: Sequence[str], into: str) -> DataFrame:
    """Put finished columns into one struct, which later scans copy as one block of bytes."""
    kept = [c for c in df.columns if c not in names]
    return df.select(*kept, (F.struct(*names) if names else F.lit(None).cast("struct<>")).alias(into))


def unpacked(df: DataFrame, packed: str) -> DataFrame:
    names = [f.name for f in df.schema[packed].dataType.fields]
    return df.select("*", *[F.col(f"{packed}.{n}").alias(n) for n in names]).drop(packed)
