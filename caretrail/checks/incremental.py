"""Incremental recompute and streaming: each result must equal the full build."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretrail.checks.care_sql import AFTER, BEFORE, ROW
from caretrail.checks.registry import check
from caretrail.operators import incremental as inc
from caretrail.operators.timeline import by_timeline, following, next_where, prev, prev_where
from caretrail.plans.spine import measured
from caretrail.session import checkpoint_dir
from caretrail.sources.datasets import Datasets
from caretrail.sources.tables import Tables, live
from caretrail.streaming import sync as st

c = F.col
COLUMNS = ["person_id", "encounter_id", "encounter_date", "prev_date", "next_date", "prev_clinical", "next_clinical"]
FULL = f"""SELECT person_id, encounter_id, encounter_date, LAG(encounter_date) {ROW} AS prev_date, LEAD(encounter_date) {ROW} AS next_date, LAST_VALUE(CASE WHEN is_clinical = 1 THEN encounter_date END IGNORE NULLS) {BEFORE} AS prev_clinical,
  FIRST_VALUE(CASE WHEN is_clinical = 1 THEN encounter_date END IGNORE NULLS) {AFTER} AS next_clinical FROM spine"""


def neighbours(t: Tables, rows: DataFrame) -> DataFrame:
    clinical = c("is_clinical") == 1
    looks = dict(
        prev_date=prev(c("encounter_date")),
        next_date=following(c("encounter_date")),
        prev_clinical=prev_where(clinical, c("encounter_date")),
        next_clinical=next_where(clinical, c("encounter_date")),
    )
    return by_timeline(rows, lambda d, line: line.scan(d, **looks), t.hot_persons).select(*COLUMNS)


def build(t: Tables, keys: DataFrame | None = None) -> DataFrame:
    return neighbours(t, measured(t, keys))


MARK = "2000-06-30"


def weighed(t: Tables, rows: DataFrame, obs: DataFrame) -> DataFrame:
    """The neighbours of each encounter, with the sum of the measurements that are known of it."""
    sums = obs.groupBy("encounter_id").agg(F.sum("value_numeric").alias("measured"))
    return neighbours(t, rows).join(sums, "encounter_id", "left").select(*COLUMNS, F.round("measured", 4).alias("measured"))


def as_it_was(t: Tables) -> DataFrame:
    """The dataset as built before the mark: later rows unknown, rows voided since still there, rows corrected since with
    their old value or, for encounters, on their old day."""
    mark = F.lit(MARK).cast("date")
    since = lambda name: F.coalesce(c(name) >= mark, F.lit(False))
    times = t.encounter.select("encounter_id", "date_created", "date_changed")
    rows = measured(t).join(times, "encounter_id").filter(c("date_created") < mark)
    rows = rows.withColumn("encounter_date", F.when(since("date_changed"), F.date_sub("encounter_date", 3)).otherwise(c("encounter_date")))
    obs = t.obs.filter(c("date_created") < mark).filter((c("voided") == 0) | since("date_voided"))
    obs = obs.withColumn("value_numeric", F.when(since("date_changed"), c("value_numeric") + 1).otherwise(c("value_numeric")))
    return weighed(t, rows.drop("date_created", "date_changed"), obs)


@check(
    "k07_recompute_changed_persons",
    "K3 K5 K6 Z3",
    f"""SELECT f.*, ROUND(m.measured, 4) AS measured FROM ({FULL}) f
      LEFT JOIN (SELECT encounter_id, SUM(value_numeric) AS measured FROM obs WHERE voided = 0 GROUP BY encounter_id) m ON m.encounter_id = f.encounter_id""",
)
def recompute(t: Tables) -> DataFrame:
    """Rows corrected and voided long after the day they are about are found by their change times alone."""

    def rebuilt(keys: DataFrame) -> DataFrame:
        return weighed(t, measured(t, keys), t.obs.filter("voided = 0").join(keys, "person_id", "left_semi"))

    return inc.recompute(as_it_was(t), inc.changed_persons(t, MARK), rebuilt)


@check("k08_rebuild_for_persons", "K8 K9 L2", FULL.replace("FROM spine", "FROM spine WHERE person_id IN (SELECT person_id FROM patient_program WHERE program_id = 3)"))
def rebuild(t: Tables) -> DataFrame:
    return build(t, t.patient_program.filter("program_id = 3").select("person_id").distinct())


@check(
    "k04_changed_encounters",
    "K4",
    """SELECT encounter_id, person_id, CASE WHEN date_created >= DATE '2001-07-01' THEN 'created' WHEN date_voided >= DATE '2001-07-01' THEN 'voided' ELSE 'changed' END AS change
      FROM encounter WHERE GREATEST(date_created, date_voided, date_changed) >= DATE '2001-07-01'""",
)
def changed(t: Tables) -> DataFrame:
    return inc.changed_encounters(t, "2001-07-01")


def shared(t: Tables, name: str) -> str:
    """A new folder that all executors reach."""
    return f"{checkpoint_dir(t.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# A row per person from all sources, with a column of the mother's: what changes anywhere, however late, has to reach it.

PERSON_ROWS = """
SELECT p.person_id, p.gender, e.visits, e.last_visit, l.results, l.result_total, o.orders, o.order_codes, r.mother_id, m.last_visit AS mother_last_visit
FROM person p
LEFT JOIN (SELECT person_id, COUNT(*) AS visits, MAX(encounter_date) AS last_visit FROM encounter WHERE voided = 0 GROUP BY 1) e ON e.person_id = p.person_id
LEFT JOIN (SELECT person_id, COUNT(*) AS results, ROUND(SUM(value_numeric), 4) AS result_total FROM lab_event GROUP BY 1) l ON l.person_id = p.person_id
LEFT JOIN (SELECT person_id, COUNT(*) AS orders, CAST(SUM(concept_id) AS BIGINT) AS order_codes FROM clinical_order GROUP BY 1) o ON o.person_id = p.person_id
LEFT JOIN (SELECT person_b, MIN(person_a) AS mother_id FROM relationship GROUP BY 1) r ON r.person_b = p.person_id
LEFT JOIN (SELECT person_id, MAX(encounter_date) AS last_visit FROM encounter WHERE voided = 0 GROUP BY 1) m ON m.person_id = r.mother_id
WHERE p.voided = 0"""
SOURCES = ("encounter", "lab_event", "clinical_order", "person")


def known_at(t: Tables, name: str, mark: str) -> DataFrame:
    """Rows of a source as they stood before the mark: later ones unknown, those voided since still there, those changed since otherwise."""
    at = F.lit(mark).cast("date")
    df = getattr(t, name)
    since = lambda column: F.coalesce(c(column) >= at, F.lit(False))
    if name == "encounter":
        df = df.filter(c("date_created") < at).withColumn("voided", F.when(since("date_voided"), 0).otherwise(c("voided")))
        return df.withColumn("encounter_date", F.when(since("date_changed"), F.date_sub("encounter_date", 3)).otherwise(c("encounter_date")))
    if name == "lab_event":
        return df.filter(c("date_created") < at).withColumn("value_numeric", c("value_numeric") + F.when(since("date_changed"), 1).otherwise(0))
    if name == "clinical_order":
        return df.filter(c("date_activated") < at).withColumn("concept_id", c("concept_id") + F.when(since("date_changed"), 1).otherwise(0))
    df = df.withColumn("voided", F.when(since("date_voided"), 0).otherwise(c("voided")))
    return df.withColumn("gender", F.when(since("date_changed"), F.lit("U")).otherwise(c("gender")))


def person_rows(t: Tables, mark: str | None = None, keys: DataFrame | None = None) -> DataFrame:
    """The dataset for some persons or all, from the sources as they are, or as they stood at a mark."""
    encounter, lab, order, person = [known_at(t, n, mark) if mark else getattr(t, n) for n in SOURCES]
    mothers = t.relationship.groupBy(c("person_b").alias("person_id")).agg(F.min("person_a").alias("mother_id"))
    if keys is not None:
        person, lab, order, mothers = [df.join(keys, "person_id", "left_semi") for df in (person, lab, order, mothers)]
        read = keys.unionByName(mothers.select(c("mother_id").alias("person_id"))).distinct()
        encounter = encounter.join(read, "person_id", "left_semi")
    visits = live(encounter).groupBy("person_id").agg(F.count(F.lit(1)).alias("visits"), F.max("encounter_date").alias("last_visit"))
    results = lab.groupBy("person_id").agg(F.count(F.lit(1)).alias("results"), F.round(F.sum("value_numeric"), 4).alias("result_total"))
    # The mother's visits are joined to the mothers, so persons without one are no common key of a join.
    last = visits.select(c("person_id").alias("mother_id"), c("last_visit").alias("mother_last_visit"))
    mothers = mothers.join(last, "mother_id", "left")
    orders = order.groupBy("person_id").agg(F.count(F.lit(1)).alias("orders"), F.sum("concept_id").alias("order_codes"))
    out = person.filter("voided = 0").select("person_id", "gender")
    for part in (visits, results, orders, mothers):
        out = out.join(part, "person_id", "left")
    return out.select(
        "person_id", "gender", "visits", "last_visit", "results", "result_total", "orders", "order_codes", "mother_id", "mother_last_visit"
    )


def changed_and_dependent(t: Tables, mark: str, until: str | None = None, sources: Sequence[str] = SOURCES, dependent: bool = True) -> DataFrame:
    keys = inc.changed_persons(t, mark, until, sources)
    return inc.with_dependents(keys, t.relationship) if dependent else keys


@check("k03_changes_of_all_sources", "K3 K5 K6 I6 E12", PERSON_ROWS)
def all_sources(t: Tables, mark: str = MARK, **limits) -> DataFrame:
    """A build that lacks what came later, and other persons' later changes, is right again after a recompute of the key set."""
    keys = changed_and_dependent(t, mark, **limits)
    return inc.recompute(person_rows(t, mark), keys, lambda k: person_rows(t, keys=k))


LATE = "2024-02-16"  # laboratory results stored from here on: about one person in a hundred


def synced(t: Tables, parts: int = 200) -> tuple[Datasets, DataFrame, DataFrame]:
    """A stored dataset without the late results, brought up to date; its files before, and the keys."""
    store = Datasets(t.spark, shared(t, "k07"), parts)
    store.create("person_rows", person_rows(t, LATE), ["person_id"])
    before = store.files("person_rows").withColumn("held", F.lit(True))
    before = inc.cut_lineage(before)
    keys = inc.cut_lineage(changed_and_dependent(t, LATE))
    store.replace("person_rows", keys, person_rows(t, keys=keys), ["person_id"])
    return store, before, keys


@check("k07_sync_stored_partitions", "K7 A13 A5 K3", PERSON_ROWS)
def sync_stored(t: Tables) -> DataFrame:
    """The late results of some persons, taken into the partitions of these persons."""
    return synced(t)[0].read("person_rows")


@check(
    "k07_untouched_partitions",
    "K7 A13",
    """SELECT 'partitions of changed persons that kept their files' AS what, 0 AS n UNION ALL SELECT 'other partitions with new files', 0
      UNION ALL SELECT 'other partitions that lost files', 0""",
)
def untouched(t: Tables) -> DataFrame:
    store, before, keys = synced(t)
    touched = keys.select(store.part(["person_id"])).distinct().select(c(store.part_column).alias("part"), F.lit(True).alias("touched"))
    both = before.join(store.files("person_rows").withColumn("now", F.lit(True)), ["part", "file"], "full").join(touched, "part", "left")
    on = lambda test: F.count_distinct(F.when(test, c("part"))).cast("int")
    held, now, own = c("held").isNotNull(), c("now").isNotNull(), c("touched").isNotNull()
    counts = both.agg(
        F.array(
            F.struct(F.lit("partitions of changed persons that kept their files").alias("what"), on(own & held & now).alias("n")),
            F.struct(F.lit("other partitions with new files").alias("what"), on(~own & ~held & now).alias("n")),
            F.struct(F.lit("other partitions that lost files").alias("what"), on(~own & held & ~now).alias("n")),
        ).alias("rows")
    )
    return counts.select(F.inline("rows"))


# Marks

RUNS = ("1998-01-01", "2000-07-01", "2002-01-01")  # until when each run takes changes in
_times = ["date_created", "date_changed", "date_voided"]
_inside = " OR ".join(f"({n} >= r.changed_from AND {n} < r.changed_to)" for n in _times)


@check(
    "k01_marks_of_three_runs",
    "K1 K2 A10",
    f"""WITH r AS (SELECT * FROM (VALUES {', '.join(f"('{b}', DATE '{a}', DATE '{b}')" for a, b in zip(('1900-01-01', *RUNS), RUNS, strict=False))}) AS v(run, changed_from, changed_to)),
     n AS (SELECT run, changed_from, changed_to, (SELECT COUNT(DISTINCT person_id) FROM encounter WHERE {_inside}) AS persons FROM r)
     SELECT run, changed_from, changed_to, persons, CAST(0 AS BIGINT) AS wrong_rows FROM n""",
)
def marks(t: Tables) -> DataFrame:
    """Runs whose marks come from the log of the one before: each change is in one span, the first one's begins at the fallback."""
    store = Datasets(t.spark, shared(t, "k01"), 20)
    out = None
    for until in RUNS:
        moment, taken = dt.datetime.fromisoformat(until), []

        def changed(since, to):
            taken.append(inc.cut_lineage(inc.changed_since(t.encounter, since.date(), _times, until=to.date())))
            return taken[0]

        def build(keys, until=until):
            rows = live(known_at(t, "encounter", until))
            rows = rows if keys is None else rows.join(keys, "person_id", "left_semi")
            return rows.groupBy("person_id").agg(F.count(F.lit(1)).alias("visits"), F.max("encounter_date").alias("last_visit"))

        store.bring_up_to("visits", moment, changed, build, run=until)
        if not taken:  # the first run builds everything; these are the changes it takes in
            changed(dt.datetime(1900, 1, 1), moment)
        stored, full = store.read("visits"), build(None)
        wrong = stored.exceptAll(full).unionByName(full.exceptAll(stored)).agg(F.count(F.lit(1)).alias("wrong_rows"))
        parts = [
            store.runs("visits").filter(c("run") == until).select(c("changed_from").cast("date"), c("changed_to").cast("date")),
            taken[0].agg(F.count(F.lit(1)).alias("persons")),
            inc.cut_lineage(wrong),  # before the next run changes the files
        ]
        for part in parts:
            part = part.withColumn("run", F.lit(until))
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out.groupBy("run").agg(*[F.max(n).alias(n) for n in ("changed_from", "changed_to", "persons", "wrong_rows")])


# A graph of datasets

CASCADE_MARK = "2001-03-31"
_visits = "SELECT encounter_id, person_id, encounter_date, location_id, LEAD(encounter_date) OVER (PARTITION BY person_id ORDER BY encounter_date, encounter_id) AS next_date FROM encounter WHERE voided = 0"


def graph(t: Tables, store: Datasets, mark: str | None) -> list[inc.Step]:
    """Visits by person; the last visit of a person; of a child's mother; and visits by site and month. Each reads the one before or the first."""

    def visits(keys):
        rows = live(known_at(t, "encounter", mark) if mark else t.encounter)
        rows = rows if keys is None else rows.join(keys, "person_id", "left_semi")
        look = dict(next_date=following(c("encounter_date")))
        rows = by_timeline(rows, lambda d, line: line.scan(d, **look), t.hot_persons, order=("encounter_date", "encounter_id"))
        return rows.select("encounter_id", "person_id", "encounter_date", "location_id", "next_date")

    def of(name, keys, on):
        rows = store.read(name)
        return rows if keys is None else rows.join(keys, on, "left_semi")

    def last(keys):
        return of("visits", keys, "person_id").groupBy("person_id").agg(F.count(F.lit(1)).alias("visits"), F.max("encounter_date").alias("last_visit"))

    def mothers(keys):
        edges = t.relationship if keys is None else t.relationship.join(keys.select(c("person_id").alias("person_b")), "person_b", "left_semi")
        visited = store.read("last_visit").select(c("person_id").alias("person_a"), "last_visit")
        return edges.join(visited, "person_a").select(c("person_b").alias("person_id"), c("person_a").alias("mother_id"), "last_visit")

    def children(rows):
        return rows.select(c("person_id").alias("person_a")).join(t.relationship, "person_a").select(c("person_b").alias("person_id"))

    month = F.trunc("encounter_date", "month").cast("date").alias("month")

    def sites(keys):
        rows = store.read("visits").select("*", month)
        rows = rows if keys is None else rows.join(keys, ["location_id", "month"], "left_semi")
        return rows.groupBy("location_id", "month").agg(F.count(F.lit(1)).alias("visits"), F.max("encounter_date").alias("last_visit"))

    def changed(since, until):
        return inc.changed_since(t.encounter, since.date(), inc.CHANGE_TIMES["encounter"], until=until.date())

    person = ("person_id",)
    return [
        inc.Step("mother_visit", person, mothers, {"last_visit": children}),
        inc.Step("site_month", ("location_id", "month"), sites, {"visits": lambda rows: rows.select("location_id", month)}),
        inc.Step("last_visit", person, last, {"visits": lambda rows: rows.select("person_id")}),
        inc.Step("visits", person, visits, {}, changed),
    ]


@check(
    "k10_cascade_graph",
    "K10",
    f"""WITH v AS ({_visits}), l AS (SELECT person_id, COUNT(*) AS n, MAX(encounter_date) AS d FROM v GROUP BY 1)
    SELECT 'visits' AS dataset, encounter_id AS id, encounter_date AS at, person_id AS n, next_date AS d FROM v
    UNION ALL SELECT 'last_visit', person_id, NULL, n, d FROM l
    UNION ALL SELECT 'mother_visit', person_b, NULL, person_a, d FROM relationship JOIN l ON person_id = person_a
    UNION ALL SELECT 'site_month', location_id, CAST(DATE_TRUNC('month', encounter_date) AS DATE), COUNT(*), MAX(encounter_date) FROM v GROUP BY 2, 3""",
)
def cascade_graph(t: Tables) -> DataFrame:
    """Four stored datasets built as of a mark, then brought up to date in order, each from the changed keys of what it reads."""
    store = Datasets(t.spark, shared(t, "k10"), 50)
    inc.cascade(store, graph(t, store, CASCADE_MARK), dt.datetime.fromisoformat(CASCADE_MARK))
    inc.cascade(store, graph(t, store, None), dt.datetime(2100, 1, 1))
    layout = {
        "visits": ("encounter_id", c("encounter_date"), "person_id", "next_date"),
        "last_visit": ("person_id", F.lit(None).cast("date"), "visits", "last_visit"),
        "mother_visit": ("person_id", F.lit(None).cast("date"), "mother_id", "last_visit"),
        "site_month": ("location_id", c("month"), "visits", "last_visit"),
    }
    out = None
    for name, (key, at, n, d) in layout.items():
        rows = store.read(name).select(F.lit(name).alias("dataset"), c(key).cast("long").alias("id"), at.alias("at"), c(n).cast("long").alias("n"), c(d).alias("d"))
        out = rows if out is None else out.unionByName(rows)
    return out


@check(
    "k10_cascade_counts",
    "K8",
    f"""WITH d AS ({FULL}), s AS (SELECT DISTINCT person_id FROM encounter WHERE date_created >= DATE '2001-07-01')
    SELECT 'timeline' AS dataset, COUNT(*) AS rows_rebuilt, COUNT(DISTINCT person_id) AS persons FROM d WHERE person_id IN (SELECT person_id FROM s)
    UNION ALL SELECT 'last_visit', COUNT(DISTINCT person_id), COUNT(DISTINCT person_id) FROM d WHERE person_id IN (SELECT person_id FROM s)""",
)
def cascade(t: Tables) -> DataFrame:
    keys = inc.changed_since(t.encounter, F.lit("2001-07-01").cast("date"), ["date_created"])
    rows = build(t, keys)
    last = rows.groupBy("person_id").agg(F.max("encounter_date").alias("last_visit"))

    def counted(df: DataFrame, name: str) -> DataFrame:
        per_person = df.groupBy("person_id").agg(F.count(F.lit(1)).alias("n"))
        return per_person.agg(F.sum("n").alias("rows_rebuilt"), F.count(F.lit(1)).alias("persons")).select(F.lit(name).alias("dataset"), "*")

    return counted(rows, "timeline").unionByName(counted(last, "last_visit"))


@check(
    "k11_streamed_lab_counts",
    "K11",
    "SELECT CAST(obs_datetime AS DATE) AS day, concept_id, COUNT(*) AS n, ROUND(SUM(value_numeric), 4) AS total FROM lab_event GROUP BY 1, 2",
)
def streamed(t: Tables) -> DataFrame:
    """Drain the event files as a stream into a shared folder, and count each event once."""
    folder = shared(t, "stream")
    events = st.lab_events(st.event_stream(t.spark, f"{t.folder}/events*.parquet"))
    st.land(events, f"{folder}/rows", f"{folder}/progress").awaitTermination()
    return st.landed(t.spark, f"{folder}/rows").groupBy(c("obs_date").alias("day"), "concept_id").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value_numeric"), 4).alias("total")
    )


def streamed_store(t: Tables) -> tuple[Datasets, str]:
    """Three deliveries of the events streamed into a stored dataset: wrong values and persons first, then their corrections and
    repeats, then the rest with the oldest event of all."""
    folder = shared(t, "k11")
    raw, source = t.raw("events"), f"{folder}/source"
    store = Datasets(t.spark, f"{folder}/datasets", 20)
    third, oldest = c("event_id") % 3, c("ts") == raw.agg(F.min("ts")).first()[0]
    wrong = raw.withColumn("value", c("value") + 1).withColumn("user_id", F.when(c("event_id") % 2 == 0, c("user_id") + 1000).otherwise(c("user_id")))
    wrong = wrong.withColumn("ts", c("ts") + F.expr("interval 2 days"))

    def build(keys):
        rows = st.landed(t.spark, f"{folder}/rows", keys)
        return rows.groupBy("person_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value_numeric"), 4).alias("total"), F.min("obs_date").alias("first_day"))

    for rows in (wrong.filter((third == 0) & ~oldest), raw.filter((third < 2) & ~oldest), raw.filter((third == 2) | oldest)):
        rows.write.mode("append").parquet(source)
        events = st.lab_events(st.event_stream(t.spark, source))
        st.keep_current(events, f"{folder}/rows", store, "totals", build, f"{folder}/progress").awaitTermination()
    runs = store.runs("totals").agg(F.max("run")).first()[0]
    # A batch that is run again after its commit: nothing is done.
    number = runs.rsplit("#", 1)[1]
    st.take_batch(store, "totals", t.spark.read.parquet(f"{folder}/rows/batch={number}"), runs, lambda keys: build(keys).limit(0))
    return store, folder


@check(
    "k11_stream_into_dataset",
    "K11",
    "SELECT person_id, COUNT(*) AS n, ROUND(SUM(value_numeric), 4) AS total, MIN(CAST(obs_datetime AS DATE)) AS first_day FROM lab_event GROUP BY 1",
)
def stream_into_dataset(t: Tables) -> DataFrame:
    return streamed_store(t)[0].read("totals")
