"""Stored datasets, marks, the cascade, delimited files and streams on small data."""

import datetime as dt
import random
from functools import partial

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from caretrail.checks import incremental as checks
from caretrail.operators.incremental import Step, cascade, changed_since, with_dependents
from caretrail.operators.timeline import Timeline, following, locf, prev
from caretrail.sources import sinks
from caretrail.sources.datasets import BEGINNING, Datasets
from caretrail.sources.tables import read_csv
from caretrail.streaming import sync as st

c = F.col
D0 = dt.date(2020, 1, 1)
T1, T2 = dt.datetime(2020, 5, 5, 12), dt.datetime(2020, 5, 6)
SCHEMA = "person_id int, encounter_date date, encounter_id int, v int, voided int"
PERSON = ("person_id",)


@pytest.fixture
def store(spark, tmp_path):
    return Datasets(spark, str(tmp_path / "store"), 16)


def timeline(rows, keys=None):
    rows = rows.filter("voided = 0")
    if keys is not None:
        rows = rows.join(keys, "person_id", "left_semi")
    line = Timeline(("person_id",), ("encounter_date", "encounter_id"))
    return line.scan(rows, last=locf(c("v")), before=prev(c("encounter_date")), after=following(c("encounter_date")))


def as_set(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def files_of(store, name):
    return {tuple(r) for r in store.files(name).collect()}


def test_sync_equals_full_rebuild_after_changes(spark, store):
    rng = random.Random(4)
    rows = [(rng.randint(0, 9), D0 + dt.timedelta(days=rng.randint(0, 60)), i, rng.choice([None, 1, 2]), 0) for i in range(80)]
    first = spark.createDataFrame(rows, SCHEMA)
    assert store.bring_up_to("timeline", T1, lambda since, until: None, partial(timeline, first)) == 80
    changed = [list(r) for r in rows]
    touched = {3}
    for i in rng.sample(range(80), 5):
        touched.add(changed[i][0])
        kind = rng.choice(["voided", "moved", "corrected"])
        if kind == "voided":
            changed[i][4] = 1
        elif kind == "moved":
            changed[i][1] = D0 + dt.timedelta(days=100)
        else:
            changed[i][3] = 9
    changed.append([3, D0, 900, 7, 0])
    gone = next(p for p in range(10) if p not in touched)
    changed = [r for r in changed if r[0] != gone]
    touched.add(gone)
    second = spark.createDataFrame([tuple(r) for r in changed], SCHEMA)
    spans, before = [], files_of(store, "timeline")

    def keys(since, until):
        spans.append((since, until))
        return spark.createDataFrame([(k,) for k in touched], "person_id bigint")  # another type than the stored one

    store.bring_up_to("timeline", T2, keys, partial(timeline, second))
    assert as_set(store.read("timeline")) == as_set(timeline(second))
    assert spans == [(T1, T2)] and store.mark("timeline") == T2
    parts = {r[0] for r in spark.createDataFrame([(k,) for k in touched], "person_id int").select(store.part(PERSON)).collect()}
    after = files_of(store, "timeline")
    assert {p for p, _ in before ^ after} <= parts and {x for x in before if x[0] not in parts} == {x for x in after if x[0] not in parts}
    # The same run once more does nothing.
    assert store.bring_up_to("timeline", T2, keys, partial(timeline, first)) == 0 and files_of(store, "timeline") == after


def test_partitions_that_lose_all_rows_and_an_empty_dataset(spark, store):
    rows = spark.createDataFrame([(i, D0, i, 1, 0) for i in range(40)], SCHEMA)
    store.create("all", rows, PERSON)
    store.replace("all", rows.select("person_id"), rows.limit(0), PERSON)
    assert store.read("all").collect() == [] and store.read("all").columns == rows.columns
    store.replace("all", rows.select("person_id").limit(0), rows, PERSON)  # no keys, nothing to do
    assert store.read("all").count() == 0
    store.replace("all", rows.select("person_id"), rows, PERSON)
    assert as_set(store.read("all")) == as_set(rows)
    store.create("all", rows.filter("person_id < 3"), PERSON)
    assert as_set(store.read("all")) == as_set(rows.filter("person_id < 3"))
    store.create("none", rows.limit(0), PERSON)
    assert store.exists("none") and store.read("none").count() == 0


def test_a_lost_writer_and_a_second_one(spark, store, monkeypatch):
    rows = spark.createDataFrame([(i, D0, i, 1, 0) for i in range(40)], SCHEMA)
    store.create("d", rows, PERSON)
    keys, new = rows.filter("person_id in (4, 5)").select("person_id"), rows.filter("person_id = 4").withColumn("v", F.lit(2))
    expected = as_set(rows.filter("person_id not in (4, 5)").unionByName(new))
    # Lost before the staged rows are complete: the old rows stay, another writer is kept out until recovery.
    with monkeypatch.context() as m:
        m.setattr(Datasets, "recover", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.replace("d", keys, new, PERSON)
    store._remove(store.path("d") + ".staged/rows/_SUCCESS")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        store.replace("d", keys, new, PERSON)
    assert as_set(store.read("d")) == as_set(rows)
    store.recover("d")
    assert as_set(store.read("d")) == as_set(rows)
    # Lost with the staged rows complete, and once more while they are put in place: recovery ends the work.
    with monkeypatch.context() as m:
        m.setattr(Datasets, "recover", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.replace("d", keys, new, PERSON)
    with monkeypatch.context() as m:
        m.setattr(Datasets, "_remove", lambda *_: (_ for _ in ()).throw(RuntimeError("lost again")))
        with pytest.raises(RuntimeError):
            store.recover("d")
    store.recover("d")
    assert as_set(store.read("d")) == expected
    store.recover("d")
    assert as_set(store.read("d")) == expected


def test_cascade_hands_on_old_and_new_rows(spark, store):
    def steps(rows):
        df = spark.createDataFrame(rows, "person_id int, month int, v int")

        def visits(keys):
            return df if keys is None else df.join(keys, "person_id", "left_semi")

        def months(keys):
            own = store.read("visits")
            own = own if keys is None else own.join(keys, "month", "left_semi")
            return own.groupBy("month").agg(F.sum("v").alias("v"))

        def total(keys):
            return store.read("months").groupBy((c("month") * 0).alias("all")).agg(F.sum("v").alias("v"))

        changed = lambda since, until: spark.createDataFrame([(2,)], "person_id int")
        return [
            Step("total", ("all",), total, {"months": lambda m: m.select((c("month") * 0).alias("all"))}),
            Step("months", ("month",), months, {"visits": lambda v: v.select("month")}),
            Step("visits", PERSON, visits, {}, changed),
        ]

    assert cascade(store, steps([(1, 1, 5), (2, 1, 6), (3, 7, 1)]), T1) == {"visits": 3, "months": 2, "total": 1}
    # Person 2 moves from month 1 to month 4: both months change, month 7 does not.
    assert cascade(store, steps([(1, 1, 5), (2, 4, 6), (3, 7, 1)]), T2) == {"visits": 1, "months": 2, "total": 1}
    assert sorted(map(tuple, store.read("months").collect())) == [(1, 5), (4, 6), (7, 1)]
    assert [tuple(r) for r in store.read("total").collect()] == [(0, 12)]
    with pytest.raises(ValueError, match="unknown"):
        cascade(store, [Step("x", PERSON, lambda keys: None, {"y": lambda r: r})], T1)


def test_run_log_and_mark(store, spark):
    assert store.mark("x") == BEGINNING and store.mark("x", T1) == T1
    store.bring_up_to("x", T1, lambda since, until: None, lambda keys: spark.range(7), ("id",))
    assert store.mark("x") == T1 and store.mark("y") == BEGINNING
    line = store.runs("x").first()
    assert (line["rows_written"], line["changed_from"], line["changed_to"]) == (7, BEGINNING, T1)


def test_dependents_are_followed_to_the_end(spark):
    edges = [(i, i + 1) for i in range(6)] + [(20, 21), (21, 20), (1, 30), (1, 31), (None, 5), (3, None)]
    edges = spark.createDataFrame(edges, "person_a int, person_b int")
    keys = lambda *k: spark.createDataFrame([(x,) for x in k], "person_id int")
    reach = lambda *k: sorted(r[0] for r in with_dependents(keys(*k), edges.filter("person_b is not null")).collect())
    assert reach(4) == [4, 5, 6] and reach(1, 1, 3) == [1, 2, 3, 4, 5, 6, 30, 31] and reach(20) == [20, 21] and reach(99) == [99] and reach() == []


@pytest.mark.parametrize("left_out", ["lab_event", "person", "clinical_order", "encounter", "dependents"])
def test_every_source_is_needed_in_the_key_set(spark, tables, left_out):
    full, mark = as_set(checks.person_rows(tables)), "2001-08-31"
    sources = [s for s in checks.SOURCES if s != left_out]
    assert as_set(checks.all_sources(tables, mark)) == full
    assert as_set(checks.all_sources(tables, mark, sources=sources, dependent=left_out != "dependents")) != full


def test_sync_of_few_persons_leaves_most_partitions(spark, tables):
    store, before, keys = checks.synced(tables)
    before = {(r.part, r.file) for r in before.collect()}
    kept = before & files_of(store, "person_rows")
    assert 0 < keys.count() < 30 and len(kept) > len(before) / 2 and kept != before


def test_changed_since_reads_every_time_column(spark):
    df = spark.createDataFrame([(1, D0, None), (2, None, D0), (3, None, None)], "person_id int, a date, b date")
    assert sorted(r[0] for r in changed_since(df, F.lit(D0), ["a", "b"]).collect()) == [1, 2]


def test_conform_checks_columns(spark):
    schema = StructType([StructField("a", IntegerType()), StructField("b", StringType())])
    assert sinks.conform(spark.createDataFrame([("x", 1)], "b string, a bigint"), schema).dtypes == [("a", "int"), ("b", "string")]
    with pytest.raises(ValueError):
        sinks.conform(spark.createDataFrame([(1,)], "a int"), schema)


def test_csv_round_trip_and_headerless_list(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", now'), (2, None)], "person_id int, note string")
    sinks.export_delimited(df, str(tmp_path / "out"))
    assert sorted(map(tuple, read_csv(spark, str(tmp_path / "out"), "person_id int, note string").collect()))[0] == (1, 'say "hi", now')
    (tmp_path / "ids.csv").write_text("5\n7\n")
    assert [r[0] for r in read_csv(spark, str(tmp_path / "ids.csv"), "person_id int", header=False).collect()] == [5, 7]


def test_inferred_types_and_rejected_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,day,note\n1,2020-01-05,x\n2,2021-02-06,\n")
    rows = sinks.read_delimited(spark, str(tmp_path / "a.csv"))
    assert [t for _, t in rows.dtypes] == ["int", "date", "string"] and rows.count() == 2
    assert "ReadSchema: struct<id:int>" in rows.select("id")._jdf.queryExecution().toString()
    (tmp_path / "b.csv").write_text("1,2020-01-05\nx,2020-01-05\n3\n4,2020-01-05,more\n5,\n")
    good, bad = sinks.load_delimited(spark, str(tmp_path / "b.csv"), str(tmp_path / "table"), "id int, day date")
    assert sorted(tuple(r) for r in good.collect()) == [(1, dt.date(2020, 1, 5)), (5, None)]
    assert sorted(r[0] for r in bad.select("rejected_line").collect()) == ["3", "4,2020-01-05,more", "x,2020-01-05"]


def test_a_batch_run_twice_changes_no_file(spark, tables):
    store, folder = checks.streamed_store(tables)
    runs = sorted(r["run"] for r in store.runs("totals").collect())
    before, rows = files_of(store, "totals"), as_set(store.read("totals"))
    assert len(runs) >= 3 and len(runs) == len(set(runs))
    for run in runs:
        assert st.take_batch(store, "totals", spark.range(3).toDF("person_id"), run, lambda keys: store.read("totals").limit(0)) == 0
    assert files_of(store, "totals") == before and as_set(store.read("totals")) == rows


def test_stream_counts_the_last_delivery_of_an_event(spark, store, tmp_path):
    source, path = tmp_path / "events", str(tmp_path / "landed")
    rows = [(i, dt.datetime(2024, 1, 1 + i % 5), i % 3, "purchase", float(i), "{}") for i in range(12)]

    def build(keys):
        return st.landed(spark, path, keys).groupBy("person_id").agg(F.count(F.lit(1)).alias("n"), F.sum("value_numeric").alias("total"))

    def deliver(events):
        spark.createDataFrame(events, st.EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(str(source))
        stream = st.lab_events(st.event_stream(spark, str(source)))
        st.keep_current(stream, path, store, "totals", build, str(tmp_path / "progress")).awaitTermination()
        return sorted(map(tuple, store.read("totals").collect()))

    assert deliver(rows) == [(0, 4, 18.0), (1, 4, 22.0), (2, 4, 26.0)]
    # The last event again, and a new one.
    assert deliver([rows[-1], (99, dt.datetime(2024, 1, 5), 2, "purchase", 100.0, "{}")]) == [(0, 4, 18.0), (1, 4, 22.0), (2, 5, 126.0)]
    # One event years before all others, in a batch of its own, together with a repeat.
    late = (500, dt.datetime(2019, 3, 1), 0, "purchase", 1000.0, "{}")
    assert deliver([late, rows[3], late]) == [(0, 5, 1018.0), (1, 4, 22.0), (2, 5, 126.0)]
    # A correction with another day, value and person: it counts once, and its first person is rebuilt too.
    assert deliver([(500, dt.datetime(2023, 3, 1), 1, "purchase", 1.0, "{}")]) == [(0, 4, 18.0), (1, 5, 23.0), (2, 5, 126.0)]
