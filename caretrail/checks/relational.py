"""Sources and sinks, predicates, joins, aggregates, sorts, sets and data quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretrail.checks.care_sql import no_patient
from caretrail.checks.incremental import shared
from caretrail.checks.registry import check
from caretrail.functions import dates as d
from caretrail.operators import aggregates as agg
from caretrail.operators import joins, newest, periods, quality, rules
from caretrail.operators.facts import extract_packed
from caretrail.plans import hiv_facts as hf
from caretrail.plans.hiv_summary import of_patients
from caretrail.plans.spine import encounters, measured
from caretrail.sources import sinks
from caretrail.sources.tables import Tables, live
from caretrail.sources.views import answer_rows_sql

c = F.col
DAY = "DATE '2000-01-01'"


def _one(flag) -> F.Column:
    return F.when(flag, 1).otherwise(0)


# A: sources and sinks


@check(
    "a01_scan_with_pushdown",
    "A1 D1",
    "SELECT encounter_id, person_id, encounter_date FROM encounter WHERE voided = 0 AND encounter_type IN (1, 14) AND encounter_date >= DATE '1999-01-01'",
)
def scan(t: Tables) -> DataFrame:
    since = c("encounter_date") >= F.lit("1999-01-01").cast("date")
    return live(t.encounter).filter(c("encounter_type").isin(1, 14) & since).select("encounter_id", "person_id", "encounter_date")


@check(
    "a02_read_delimited_lines",
    "A2",
    "SELECT encounter_id, person_id, CAST(encounter_type AS INTEGER) AS encounter_type, encounter_date FROM encounter",
)
def read_lines(t: Tables) -> DataFrame:
    lines = sinks.delimited_lines(t.encounter.select("encounter_id", "person_id", "encounter_type", "encounter_date"))
    schema = "encounter_id bigint, person_id bigint, encounter_type int, encounter_date date"
    return lines.select(F.from_csv("line", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


@check(
    "a04_export_delimited",
    "A4",
    """SELECT '"' || encounter_id || '","' || person_id || '","' || encounter_type || '","' || encounter_date || '"' AS line FROM encounter""",
)
def export(t: Tables) -> DataFrame:
    return sinks.delimited_lines(t.encounter.select("encounter_id", "person_id", "encounter_type", "encounter_date"))


@check(
    "a02_delimited_files",
    "A2 A4",
    "SELECT encounter_id, encounter_type, encounter_date, location_id + 1 AS next_site FROM encounter WHERE encounter_type <> 116",
)
def delimited_files(t: Tables) -> DataFrame:
    """Encounters exported to quoted files with a header and read back by inferred types, four columns of seven."""
    path = f"{shared(t, 'a02')}/encounters"
    sinks.export_delimited(t.encounter.drop("date_voided", "date_changed", "encounter_datetime"), path)
    rows = sinks.read_delimited(t.spark, path).filter("encounter_type <> 116")
    return rows.select(c("encounter_id").cast("long"), "encounter_type", "encounter_date", (c("location_id") + 1).alias("next_site"))


@check("a03_headerless_list", "A3 E3", "SELECT DISTINCT person_id FROM patient_program WHERE program_id = 2")
def headerless_list(t: Tables) -> DataFrame:
    """A list of persons in files of one column without a header, loaded into a table."""
    folder = shared(t, "a03")
    t.patient_program.filter("program_id = 2").select("person_id").distinct().write.csv(f"{folder}/list")
    return sinks.load_delimited(t.spark, f"{folder}/list", f"{folder}/table", "person_id bigint")[0]


_spoilt = "CASE WHEN encounter_id % 97 = 5 THEN 'number' WHEN encounter_id % 89 = 7 THEN 'columns' WHEN encounter_id % 83 = 9 THEN 'date' END"
_line = {
    "number": "encounter_id || ',many,' || encounter_date",
    "columns": "encounter_id || ',' || encounter_type",
    "date": "encounter_id || ',' || encounter_type || ',in ' || encounter_date",
}
_lines = f"CASE spoilt {' '.join(f"WHEN '{k}' THEN {v}" for k, v in _line.items())} ELSE encounter_id || ',' || encounter_type || ',' || encounter_date END"


@check(
    "a04_rejected_lines",
    "A2 A4",
    f"""SELECT CASE WHEN spoilt IS NULL THEN encounter_id END AS encounter_id, CASE WHEN spoilt IS NULL THEN encounter_type END AS encounter_type,
      CASE WHEN spoilt IS NULL THEN encounter_date END AS encounter_date, CASE WHEN spoilt IS NOT NULL THEN {_lines} END AS rejected_line FROM (SELECT *, {_spoilt} AS spoilt FROM encounter)""",
)
def rejected_lines(t: Tables) -> DataFrame:
    """Lines of encounters, some of them spoilt, loaded by a schema: the rows of good ones, and the bad ones as they are."""
    folder = shared(t, "a04")
    t.encounter.withColumn("spoilt", F.expr(_spoilt)).select(F.expr(_lines).alias("line")).write.text(f"{folder}/lines")
    rows, rejected = sinks.load_delimited(t.spark, f"{folder}/lines", f"{folder}/table", "encounter_id bigint, encounter_type int, encounter_date date")
    return rows.unionByName(rejected, allowMissingColumns=True)


@check(
    "a06_keyed_upsert",
    "A6",
    """SELECT encounter_id, person_id, CASE WHEN date_created >= DATE '2001-01-01' THEN encounter_type + 1000 ELSE encounter_type END AS encounter_type FROM encounter
      UNION ALL SELECT encounter_id + 100000000, person_id, 7 FROM encounter WHERE encounter_date >= DATE '2001-07-01'""",
)
def upsert(t: Tables) -> DataFrame:
    old = t.encounter.select("encounter_id", "person_id", "encounter_type")
    changed = t.encounter.filter(c("date_created") >= F.lit("2001-01-01").cast("date")).select("encounter_id", "person_id", (c("encounter_type") + 1000).alias("encounter_type"))
    added = t.encounter.filter(c("encounter_date") >= F.lit("2001-07-01").cast("date")).select(
        (c("encounter_id") + 100000000).alias("encounter_id"), "person_id", F.lit(7).alias("encounter_type")
    )
    return sinks.upsert(old, changed.unionByName(added), ["encounter_id"])


@check(
    "a07_delete_affected_keys",
    "A7 A8",
    """SELECT encounter_id, person_id FROM encounter WHERE person_id NOT IN (SELECT person_id FROM person WHERE voided = 1)
      AND person_id NOT IN (SELECT person_id FROM encounter WHERE date_created >= DATE '2001-07-20')""",
)
def delete_keys(t: Tables) -> DataFrame:
    affected = t.encounter.filter(c("date_created") >= F.lit("2001-07-20").cast("date")).select("person_id").distinct()
    rows = t.encounter.select("encounter_id", "person_id")
    return sinks.delete_keys(sinks.delete_keys(rows, affected, ["person_id"]), t.person.filter("voided = 1"), ["person_id"])


@check(
    "a09_insert_ignore",
    "A9 M34",
    """SELECT person_id, MIN(source) AS source FROM (SELECT person_id, 'a registry' AS source FROM person WHERE death_date IS NOT NULL
      UNION ALL SELECT DISTINCT person_id, 'b encounter' FROM encounter WHERE voided = 1) GROUP BY person_id""",
)
def insert_ignore(t: Tables) -> DataFrame:
    known = t.person.filter("death_date IS NOT NULL").select("person_id", F.lit("a registry").alias("source"))
    more = t.encounter.filter("voided = 1").select("person_id", F.lit("b encounter").alias("source"))
    return sinks.insert_ignore(known, more, ["person_id"])


@check(
    "a10_run_log_row",
    "F15",
    """SELECT 'encounter' AS table_name, COALESCE(MAX(CASE WHEN voided = 0 THEN date_created END), DATE '1900-01-01') AS date_updated, COUNT(*) AS rows_written FROM encounter
      UNION ALL SELECT 'obs', COALESCE(MAX(CASE WHEN voided = 0 THEN obs_date END), DATE '1900-01-01'), COUNT(*) FROM obs""",
)
def run_log(t: Tables) -> DataFrame:
    def row(df: DataFrame, name: str, stamp: str) -> DataFrame:
        mark = F.coalesce(F.max(F.when(c("voided") == 0, c(stamp))), F.lit("1900-01-01").cast("date"))
        return df.agg(mark.alias("date_updated"), F.count(F.lit(1)).alias("rows_written")).select(F.lit(name).alias("table_name"), "*")

    return row(t.encounter, "encounter", "date_created").unionByName(row(t.obs, "obs", "obs_date"))


def _calendar(name: str, ids: str, unit: str, ends_sql: str, key_sql: str):
    @check(
        name,
        ids,
        f"""WITH cal AS ({ends_sql})
        SELECT period_end, {key_sql} AS period_key, COUNT(encounter_id) AS encounters
        FROM cal LEFT JOIN encounter ON encounter_date > prev_end AND encounter_date <= period_end GROUP BY 1, 2""",
    )
    def run(t: Tables) -> DataFrame:
        # Every event falls in one period, so it is keyed to it and joined by equality.
        calendar = periods.calendar(t.spark, unit, "1994-12-01", "2001-12-31").select("period_end", "period_key")
        end = {"month": F.last_day("encounter_date"), "week": periods.week_end(c("encounter_date")), "day": c("encounter_date")}[unit]
        counts = t.encounter.groupBy(end.alias("period_end")).agg(F.count(F.lit(1)).alias("n"))
        return calendar.join(counts, "period_end", "left").select(
            "period_end", "period_key", F.coalesce("n", F.lit(0)).alias("encounters")
        )


_calendar(
    "a11_month_calendar",
    "A11 J14",
    "month",
    "SELECT LAST_DAY(CAST(d AS DATE)) AS period_end, CAST(d AS DATE) - 1 AS prev_end FROM GENERATE_SERIES(DATE '1994-12-01', DATE '2001-12-01', INTERVAL 1 MONTH) AS g(d)",
    "CAST(STRFTIME(period_end, '%Y%m') AS INTEGER)",
)
_calendar(
    "a12_week_calendar",
    "A12 J13",
    "week",
    "SELECT CAST(d AS DATE) AS period_end, CAST(d AS DATE) - 7 AS prev_end FROM GENERATE_SERIES(DATE '1994-12-03', DATE '2001-12-31', INTERVAL 7 DAY) AS g(d)",
    """CASE WHEN CAST(STRFTIME(period_end - 6, '%U') AS INTEGER) > 0 THEN YEAR(period_end - 6) * 100 + CAST(STRFTIME(period_end - 6, '%U') AS INTEGER)
       ELSE (YEAR(period_end - 6) - 1) * 100 + CAST(STRFTIME(MAKE_DATE(YEAR(period_end - 6) - 1, 12, 31), '%U') AS INTEGER) END""",
)
_calendar(
    "a12_day_calendar",
    "A12",
    "day",
    "SELECT CAST(d AS DATE) AS period_end, CAST(d AS DATE) - 1 AS prev_end FROM GENERATE_SERIES(DATE '1994-12-01', DATE '2001-12-31', INTERVAL 1 DAY) AS g(d)",
    "CAST(STRFTIME(period_end, '%Y%m%d') AS INTEGER)",
)

# D: projections and predicates


@check(
    "d02_negative_observation_filter",
    "D2",
    f"SELECT encounter_id FROM encounter e WHERE voided = 0 AND {no_patient('negq')}",
    views={"negq": answer_rows_sql(hf.QUESTIONS)},
)
def negative_filter(t: Tables) -> DataFrame:
    facts = {n: hf.FACTS[n] for n in hf.EXCLUDING}
    answers = extract_packed(t.answers(hf.QUESTIONS), ["encounter_id"], facts)
    return of_patients(live(t.encounter).join(answers, "encounter_id", "left"), facts).select("encounter_id")


@check(
    "d03_encounter_flags",
    "D3 D4 D5 D10",
    """SELECT e.encounter_id, CASE WHEN encounter_type IN (1, 2, 14) THEN 1 WHEN encounter_type = 116 AND visit_type_id IS NOT NULL AND visit_type_id NOT IN (24, 25, 80, 104) THEN 1 ELSE 0 END AS is_clinical,
      CASE encounter_type WHEN 116 THEN 10 WHEN 21 THEN 1 ELSE 10 END AS day_rank, CASE WHEN visit_type_id = 24 THEN 1 WHEN visit_type_id IS NOT NULL THEN 0 END AS is_transit
      FROM encounter e LEFT JOIN visit v ON v.visit_id = e.encounter_id""",
)
def flags(t: Tables) -> DataFrame:
    # Type 116 stands for the type that visit types gate.
    kind = F.when(c("encounter_type") == 116, 186).otherwise(c("encounter_type"))
    visits = t.visit.select(c("visit_id").alias("encounter_id"), "visit_type_id")
    df = t.encounter.join(visits, "encounter_id", "left").withColumn("kind", kind)
    return df.select(
        "encounter_id",
        rules.is_clinical(c("kind"), c("visit_type_id")).alias("is_clinical"),
        rules.day_rank(c("kind")).alias("day_rank"),
        rules.is_transit(c("visit_type_id")).alias("is_transit"),
    )


@check(
    "d06_test_patient_removal",
    "D6 E4",
    "SELECT encounter_id FROM encounter WHERE voided = 0 AND person_id NOT IN (SELECT person_id FROM person WHERE voided = 1 OR is_test = 1)",
)
def real_patients(t: Tables) -> DataFrame:
    return encounters(t).select("encounter_id")


@check(
    "d07_period_predicates",
    "D7 D8 D9 D11 J14 J15 J27",
    """SELECT encounter_id, CASE WHEN encounter_date BETWEEN DATE '1998-01-01' AND DATE '1999-12-31' THEN 1 ELSE 0 END AS in_window,
      CASE WHEN encounter_date BETWEEN DATE_TRUNC('month', date_created) AND date_created THEN 1 ELSE 0 END AS month_to_date,
      CASE WHEN location_id IS NOT NULL AND location_id <> 0 THEN location_id ELSE -1 END AS site, LAST_DAY(encounter_date) AS month_end,
      STRFTIME(encounter_date, '%Y%m') AS month_key, CAST(DATE_TRUNC('month', encounter_date) AS DATE) AS month_start FROM encounter""",
)
def period_predicates(t: Tables) -> DataFrame:
    seen = c("encounter_date")
    return t.encounter.select(
        "encounter_id",
        _one(seen.between(F.lit("1998-01-01").cast("date"), F.lit("1999-12-31").cast("date"))).alias("in_window"),
        _one(d.within_month_of(seen, c("date_created"))).alias("month_to_date"),
        F.when(c("location_id").isNotNull() & (c("location_id") != 0), c("location_id")).otherwise(-1).alias("site"),
        F.last_day(seen).alias("month_end"),
        d.month_key(seen).alias("month_key"),
        d.month_start(seen).alias("month_start"),
    )


@check(
    "d12_timeliness",
    "D12",
    """SELECT encounter_id, CASE WHEN LAST_DAY(date_created) = LAST_DAY(encounter_date) THEN 1 ELSE 0 END AS by_month_end, CASE WHEN date_created < LAST_DAY(encounter_date) + 3 THEN 1 ELSE 0 END AS by_3rd,
      CASE WHEN date_created < LAST_DAY(encounter_date) + 10 THEN 1 ELSE 0 END AS by_10th FROM encounter""",
)
def timeliness(t: Tables) -> DataFrame:
    tests = d.timely(c("date_created"), c("encounter_date"))
    return t.encounter.select("encounter_id", *[_one(v).alias(k) for k, v in tests.items()])


# E: joins


@check(
    "e01_inner_and_left_joins",
    "E1 E2",
    """SELECT e.encounter_id, l.name, v.visit_type_id, g.program_id FROM encounter e JOIN location l ON l.location_id = e.location_id
      LEFT JOIN visit v ON v.visit_id = e.encounter_id LEFT JOIN patient_program g ON g.patient_program_id = e.encounter_id WHERE e.voided = 0""",
)
def inner_left(t: Tables) -> DataFrame:
    visits = t.visit.select(c("visit_id").alias("encounter_id"), "visit_type_id")
    programs = t.patient_program.select(c("patient_program_id").alias("encounter_id"), "program_id")
    return (
        live(t.encounter)
        .join(t.location, "location_id")
        .join(visits, "encounter_id", "left")
        .join(programs, "encounter_id", "left")
        .select("encounter_id", "name", "visit_type_id", "program_id")
    )


@check("e03_key_set_restriction", "E3", "SELECT encounter_id FROM encounter WHERE person_id IN (SELECT person_id FROM patient_program WHERE program_id = 2)")
def semi(t: Tables) -> DataFrame:
    return joins.restrict(t.encounter, t.patient_program.filter("program_id = 2"), ["person_id"]).select("encounter_id")


@check("e04_set_difference", "E4 I5 R4", "SELECT person_id FROM person WHERE person_id NOT IN (SELECT person_id FROM encounter) UNION ALL SELECT person_id FROM person WHERE person_id IN (SELECT person_id FROM person WHERE death_date IS NOT NULL)")
def anti(t: Tables) -> DataFrame:
    never = joins.exclude(t.person, t.encounter, ["person_id"]).select("person_id")
    return never.unionByName(t.person.filter("death_date IS NOT NULL").select("person_id"))


LAB_DAY_SQL = """labs AS (SELECT person_id, obs_date AS test_date, CAST(COUNT(*) AS BIGINT) AS n_results FROM obs WHERE voided = 0 AND concept_id IN (856, 5497) GROUP BY 1, 2),
     ords AS (SELECT person_id, date_activated AS test_date, CAST(COUNT(*) AS BIGINT) AS n_orders FROM clinical_order GROUP BY 1, 2)"""


def _lab_days(t: Tables) -> tuple[DataFrame, DataFrame]:
    labs = live(t.obs).filter(c("concept_id").isin(856, 5497)).groupBy("person_id", c("obs_date").alias("test_date"))
    orders = t.clinical_order.groupBy("person_id", c("date_activated").alias("test_date"))
    return labs.agg(F.count(F.lit(1)).alias("n_results")), orders.agg(F.count(F.lit(1)).alias("n_orders"))


@check("e05_join_on_person_and_day", "E5", f"WITH {LAB_DAY_SQL} SELECT person_id, test_date, n_results, n_orders FROM labs JOIN ords USING (person_id, test_date)")
def day_join(t: Tables) -> DataFrame:
    labs, orders = _lab_days(t)
    return labs.join(orders, ["person_id", "test_date"])


@check("e06_full_outer_merge", "E6 M5 E16", f"WITH {LAB_DAY_SQL} SELECT person_id, test_date, n_results, n_orders FROM labs FULL OUTER JOIN ords USING (person_id, test_date)")
def outer_merge(t: Tables) -> DataFrame:
    from caretrail.plans.flat_tables import labs_and_orders_by_day

    return labs_and_orders_by_day(*_lab_days(t))


MONTHS = "months AS (SELECT LAST_DAY(CAST(d AS DATE)) AS period_end FROM GENERATE_SERIES((SELECT CAST(DATE_TRUNC('month', MIN(encounter_date)) AS DATE) FROM encounter), (SELECT MAX(encounter_date) FROM encounter), INTERVAL 1 MONTH) AS g(d))"
NEXT = "nx AS (SELECT encounter_id, person_id, encounter_date, location_id, rtc_date, LEAD(encounter_date) OVER (PARTITION BY person_id ORDER BY encounter_date, day_rank, encounter_id) AS next_date FROM spine WHERE is_clinical = 1)"


@check(
    "e07_period_validity_join",
    "E7 Z15",
    f"WITH {MONTHS}, {NEXT} SELECT period_end, person_id, encounter_id FROM nx JOIN months ON encounter_date <= period_end AND (next_date IS NULL OR next_date > period_end)",
)
def validity(t: Tables) -> DataFrame:
    from caretrail.operators.timeline import by_timeline, following

    df = measured(t).filter("is_clinical = 1")
    df = by_timeline(df, lambda x, line: line.scan(x, next_date=following(c("encounter_date"))), t.hot_persons, tasks=t.tasks())
    out = periods.valid_in_period(df, "month", c("encounter_date"), c("next_date"), *t.horizon("month"))
    return out.select("period_end", "person_id", "encounter_id")


@check(
    "e08_latest_before_period_end",
    "E8 E9 A12",
    f"""WITH {MONTHS}, p AS (SELECT m.period_end, e.*, ROW_NUMBER() OVER (PARTITION BY m.period_end, person_id ORDER BY date_enrolled DESC, patient_program_id DESC) AS n
      FROM patient_program e JOIN months m ON e.date_enrolled <= m.period_end)
    SELECT period_end, person_id, patient_program_id, program_id FROM p WHERE n = 1""",
)
def as_of(t: Tables) -> DataFrame:
    programs = t.patient_program.select("person_id", "patient_program_id", "program_id", "date_enrolled")
    out = periods.as_of(programs, "month", "date_enrolled", ["person_id"], ["date_enrolled", "patient_program_id"], *t.horizon("month"))
    return out.select("period_end", "person_id", "patient_program_id", "program_id")


@check(
    "e10_weekly_validity_latest",
    "E10",
    f"""WITH weeks AS (SELECT CAST(d AS DATE) AS period_end FROM GENERATE_SERIES((SELECT MIN(encounter_date) + CAST((6 - DAYOFWEEK(MIN(encounter_date))) AS INTEGER) FROM encounter), (SELECT MAX(encounter_date) + 6 FROM encounter), INTERVAL 7 DAY) AS g(d)), {NEXT},
     v AS (SELECT period_end, person_id, encounter_id, ROW_NUMBER() OVER (PARTITION BY period_end, person_id ORDER BY encounter_date DESC, encounter_id DESC) AS n FROM nx
       JOIN weeks ON encounter_date <= period_end AND (next_date IS NULL OR next_date > period_end OR rtc_date > period_end))
    SELECT period_end, person_id, encounter_id FROM v WHERE n = 1""",
)
def weekly(t: Tables) -> DataFrame:
    from caretrail.operators.timeline import by_timeline, following

    df = measured(t).filter("is_clinical = 1")
    df = by_timeline(df, lambda x, line: line.scan(x, next_date=following(c("encounter_date"))), t.hot_persons, tasks=t.tasks())
    until = F.when(c("next_date").isNotNull(), F.greatest("next_date", "rtc_date"))
    out = periods.valid_in_period(df, "week", c("encounter_date"), until, *t.horizon("week"))
    out = out.select("period_end", "person_id", "encounter_date", "encounter_id")
    return agg.latest_per(out, ["period_end", "person_id"], ["encounter_date", "encounter_id"]).drop("encounter_date")


@check(
    "e11_last_row_of_person",
    "E11 H3",
    """WITH r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY person_id ORDER BY encounter_date DESC, day_rank DESC, encounter_id DESC) AS n FROM spine)
    SELECT s.encounter_id, r.encounter_id AS last_encounter_id, r.rtc_date AS last_rtc_date FROM spine s JOIN r ON r.person_id = s.person_id AND r.n = 1""",
)
def last_row(t: Tables) -> DataFrame:
    df = measured(t)
    order = ["encounter_date", "day_rank", "encounter_id"]
    last = agg.latest_per(df.select("person_id", *order, "rtc_date"), ["person_id"], order)
    last = last.select("person_id", c("encounter_id").alias("last_encounter_id"), c("rtc_date").alias("last_rtc_date"))
    return df.select("person_id", "encounter_id").join(last, "person_id").drop("person_id")


@check(
    "h03_last_visit_of_month",
    "H3 E8",
    """WITH r AS (SELECT *, CAST(DATE_TRUNC('month', encounter_date) AS DATE) AS month, ROW_NUMBER() OVER (PARTITION BY person_id, DATE_TRUNC('month', encounter_date) ORDER BY encounter_date DESC, day_rank DESC, encounter_id DESC) AS n FROM spine)
    SELECT person_id, month, encounter_id, encounter_date, rtc_date, vl FROM r WHERE n = 1""",
)
def last_of_month(t: Tables) -> DataFrame:
    month = F.trunc("encounter_date", "month").alias("month")
    narrow = encounters(t).select("person_id", month, "encounter_date", c("day_rank").cast("tinyint").alias("day_rank"), "encounter_id")
    out = newest.last_rows(measured(t), narrow, ["person_id", "month"], ["encounter_date", "day_rank", "encounter_id"], "encounter_id")
    return out.select("person_id", month, "encounter_id", "encounter_date", "rtc_date", "vl")


@check(
    "e12_child_to_mother",
    "E12 P5",
    """SELECT c.person_id, MIN(m.person_id) AS mother_id FROM person c LEFT JOIN relationship r ON r.person_b = c.person_id AND r.relationship = 2
      LEFT JOIN person m ON m.person_id = r.person_a AND m.gender = 'F' GROUP BY c.person_id""",
)
def child_mother(t: Tables) -> DataFrame:
    return joins.mothers(t.person.select("person_id"), t.relationship, t.person)


@check(
    "e13_events_by_kind",
    "E13",
    """SELECT p.person_id, MAX(CASE WHEN encounter_type = 21 THEN encounter_date END) AS outreach_date, MAX(CASE WHEN encounter_type = 116 THEN encounter_date END) AS triage_date,
      MAX(CASE WHEN encounter_type = 14 THEN encounter_date END) AS exit_date FROM person p LEFT JOIN encounter e ON e.person_id = p.person_id GROUP BY p.person_id""",
)
def by_kind(t: Tables) -> DataFrame:
    kinds = {"outreach_date": 21, "triage_date": 116, "exit_date": 14}
    tests = {n: c("encounter_type") == k for n, k in kinds.items()}
    return joins.with_event_dates(t.person.select("person_id"), t.encounter, tests, "encounter_date")


@check(
    "e14_typed_attributes",
    "E14 J23 J24",
    """SELECT p.person_id, MAX(CASE WHEN attribute_type_id = 10 THEN value END) AS phone, MAX(CASE WHEN attribute_type_id = 68 THEN value END) AS case_manager,
      ANY_VALUE(COALESCE(given_name, '') || ' ' || COALESCE(middle_name, '') || ' ' || COALESCE(family_name, '')) AS full_name
      FROM person p LEFT JOIN person_attribute a ON a.person_id = p.person_id LEFT JOIN person_name n ON n.person_id = p.person_id GROUP BY p.person_id""",
)
def attributes(t: Tables) -> DataFrame:
    from caretrail.functions.text import full_name

    names = t.person_name.select("person_id", full_name(c("given_name"), c("middle_name"), c("family_name")).alias("full_name"))
    df = joins.with_attributes(t.person.select("person_id"), t.person_attribute, {"phone": 10, "case_manager": 68})
    return df.join(names, "person_id", "left")


@check(
    "e15_first_event_after",
    "E15",
    """SELECT e.encounter_id, MIN(g.date_completed) AS exit_date FROM encounter e LEFT JOIN patient_program g ON g.person_id = e.person_id AND g.date_completed > e.encounter_date GROUP BY e.encounter_id""",
)
def event_after(t: Tables) -> DataFrame:
    exits = t.patient_program.filter("date_completed IS NOT NULL")
    rows = t.encounter.select("encounter_id", "person_id", "encounter_date")
    out = joins.first_after(rows, exits, "person_id", "encounter_date", "date_completed", "exit_date", t.hot_persons)
    return out.select("encounter_id", "exit_date")


@check(
    "e17_overlay_merge",
    "E16 E17",
    """WITH a AS (SELECT encounter_id, MIN(value_coded) AS code, COUNT(*) AS n FROM obs WHERE concept_id = 1250 GROUP BY 1),
      b AS (SELECT encounter_id, MIN(value_coded) AS code, MIN(obs_date) AS day FROM obs WHERE concept_id = 1255 GROUP BY 1),
      o AS (SELECT encounter_id, MIN(date_activated) AS day FROM clinical_order GROUP BY 1),
      k AS (SELECT encounter_id FROM a UNION SELECT encounter_id FROM b UNION SELECT encounter_id FROM o)
    SELECT k.encounter_id, CASE WHEN b.encounter_id IS NOT NULL THEN b.code ELSE a.code END AS code, a.n, CASE WHEN o.encounter_id IS NOT NULL THEN o.day ELSE b.day END AS day
    FROM k LEFT JOIN a USING (encounter_id) LEFT JOIN b USING (encounter_id) LEFT JOIN o USING (encounter_id)""",
)
def overlay(t: Tables) -> DataFrame:
    key = "encounter_id"
    a = t.obs.filter("concept_id = 1250").groupBy(key).agg(F.min("value_coded").alias("code"), F.count(F.lit(1)).alias("n"))
    b = t.obs.filter("concept_id = 1255").groupBy(key).agg(F.min("value_coded").alias("code"), F.min("obs_date").alias("day"))
    o = t.clinical_order.groupBy(key).agg(F.min("date_activated").alias("day"))
    return joins.overlay([a, b, o], [key])


# F: aggregates


@check(
    "f01_group_counts",
    "F1 F6 F9 H4",
    """SELECT location_id, encounter_type, COUNT(*) AS n, MIN(encounter_date) AS first_day, MAX(date_created) AS last_entry, ROUND(AVG(date_created - encounter_date), 4) AS avg_delay
      FROM encounter WHERE voided = 0 GROUP BY location_id, encounter_type HAVING COUNT(*) > 100""",
)
def group_counts(t: Tables) -> DataFrame:
    df = live(t.encounter).groupBy("location_id", "encounter_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("encounter_date").alias("first_day"),
        F.max("date_created").alias("last_entry"),
        F.round(F.avg(F.datediff("date_created", "encounter_date")), 4).alias("avg_delay"),
    )
    return df.filter("n > 100").orderBy("location_id", "encounter_type")


@check(
    "f02_conditional_counts",
    "F2 M33",
    """SELECT CAST(DATE_TRUNC('month', encounter_date) AS DATE) AS month, COUNT(CASE WHEN encounter_type = 1 THEN 1 END) AS adult, COUNT(CASE WHEN encounter_type = 14 THEN 1 END) AS child,
      COUNT(CASE WHEN encounter_type = 21 THEN 1 END) AS outreach FROM encounter WHERE voided = 0 GROUP BY 1""",
)
def conditional(t: Tables) -> DataFrame:
    kinds = {"adult": 1, "child": 14, "outreach": 21}
    df = live(t.encounter).withColumn("month", d.month_start(c("encounter_date")))
    return agg.conditional_counts(df, {n: c("encounter_type") == k for n, k in kinds.items()}, ["month"])


@check(
    "f03_distinct_indicators_rollup",
    "F3 F5 L3",
    """WITH x AS (SELECT l.county, e.location_id, e.person_id, e.encounter_type FROM encounter e JOIN location l ON l.location_id = e.location_id WHERE voided = 0)
    SELECT county, location_id, COUNT(DISTINCT person_id) AS patients, COUNT(DISTINCT CASE WHEN encounter_type = 1 THEN person_id END) AS adults,
      COUNT(DISTINCT CASE WHEN encounter_type = 21 THEN person_id END) AS outreach FROM x GROUP BY ROLLUP (county, location_id)""",
)
def distinct_rollup(t: Tables) -> DataFrame:
    df = live(t.encounter).join(t.location, "location_id")
    tests = {"patients": F.lit(True), "adults": c("encounter_type") == 1, "outreach": c("encounter_type") == 21}
    return agg.indicator_counts(df, tests, ["county", "location_id"], rollup=True)


@check(
    "f04_ratios",
    "F4 F8 J28",
    """SELECT location_id, ROUND(COUNT(CASE WHEN encounter_type = 21 THEN 1 END) * 100.0 / NULLIF(COUNT(*), 0), 1) AS pct_outreach,
      ROUND(COUNT(*) * 1.0 / NULLIF(COUNT(DISTINCT encounter_date), 0), 4) AS per_day, ROUND(COUNT(*) * 1.0 / NULLIF(COUNT(CASE WHEN encounter_type = 999 THEN 1 END), 0), 4) AS none
      FROM encounter GROUP BY location_id""",
)
def ratios(t: Tables) -> DataFrame:
    # Distinct days by a pre-aggregate per (site, day), not by a distinct over the site's rows.
    per_day = t.encounter.groupBy("location_id", "encounter_date").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(c("encounter_type") == 21, 1)).alias("o"), F.count(F.when(c("encounter_type") == 999, 1)).alias("z")
    )
    sums = per_day.groupBy("location_id").agg(F.sum("n").alias("n"), F.sum("o").alias("o"), F.sum("z").alias("z"), F.count(F.lit(1)).alias("days"))
    return sums.select(
        "location_id",
        agg.ratio(c("o"), c("n"), 1, 100.0).alias("pct_outreach"),
        agg.ratio(c("n"), c("days")).alias("per_day"),
        agg.ratio(c("n"), c("z")).alias("none"),
    )


@check(
    "f07_average_of_counts",
    "F7",
    "SELECT location_id, ROUND(AVG(n), 4) AS avg_per_month FROM (SELECT location_id, DATE_TRUNC('month', encounter_date) AS m, COUNT(*) AS n FROM encounter GROUP BY 1, 2) GROUP BY 1",
)
def average_counts(t: Tables) -> DataFrame:
    monthly = t.encounter.groupBy("location_id", F.trunc("encounter_date", "month").alias("m")).agg(F.count(F.lit(1)).alias("n"))
    return monthly.groupBy("location_id").agg(F.round(F.avg("n"), 4).alias("avg_per_month"))


@check(
    "f10_distinct_text",
    "F10",
    "SELECT person_id, STRING_AGG(DISTINCT identifier, ', ' ORDER BY identifier) AS identifiers FROM patient_identifier GROUP BY person_id",
)
def distinct_text(t: Tables) -> DataFrame:
    return t.patient_identifier.groupBy("person_id").agg(agg.distinct_text(c("identifier")).alias("identifiers"))


@check(
    "f12_interval_buckets",
    "F12",
    """SELECT location_id, COUNT(CASE WHEN late BETWEEN 0 AND 0 THEN 1 END) AS on_day, COUNT(CASE WHEN late BETWEEN 1 AND 7 THEN 1 END) AS d1_7, COUNT(CASE WHEN late BETWEEN 1 AND 14 THEN 1 END) AS d1_14,
      COUNT(CASE WHEN late BETWEEN 1 AND 30 THEN 1 END) AS d1_30 FROM (SELECT location_id, date_created - encounter_date AS late FROM encounter) GROUP BY location_id""",
)
def buckets(t: Tables) -> DataFrame:
    late = F.datediff("date_created", "encounter_date")
    return agg.bucket_counts(t.encounter, late, {"on_day": (0, 0), "d1_7": (1, 7), "d1_14": (1, 14), "d1_30": (1, 30)}, ["location_id"])


@check(
    "f13_crosstab",
    "F13 P6",
    """SELECT location_id, gender, COUNT(CASE WHEN encounter_type = 1 THEN 1 END) AS n_1, COUNT(CASE WHEN encounter_type = 2 THEN 1 END) AS n_2, COUNT(CASE WHEN encounter_type = 21 THEN 1 END) AS n_21
      FROM encounter JOIN person USING (person_id) GROUP BY location_id, gender""",
)
def crosstab(t: Tables) -> DataFrame:
    return agg.crosstab(t.encounter.join(t.person.select("person_id", "gender"), "person_id"), ["location_id", "gender"], "encounter_type", [1, 2, 21])


@check(
    "f15_self_check_counts",
    "F15",
    "SELECT COUNT(*) AS rows_expected, COUNT(DISTINCT person_id) AS persons, COUNT(CASE WHEN voided = 1 THEN 1 END) AS voided_rows FROM encounter",
)
def self_check(t: Tables) -> DataFrame:
    per_person = t.encounter.groupBy("person_id").agg(F.count(F.lit(1)).alias("n"), F.sum("voided").alias("v"))
    return per_person.agg(F.sum("n").alias("rows_expected"), F.count(F.lit(1)).alias("persons"), F.sum("v").alias("voided_rows"))


@check(
    "f16_identifier_precedence",
    "F16 P4",
    """SELECT person_id, MIN(CASE WHEN identifier_type = 8 THEN identifier END) AS universal, MIN(CASE WHEN identifier_type IN (1, 2) THEN identifier END) AS local,
      MIN(CASE WHEN identifier_type = 3 THEN identifier END) AS study, COALESCE(MIN(CASE WHEN identifier_type = 8 THEN identifier END), MIN(CASE WHEN identifier_type IN (1, 2) THEN identifier END),
      MIN(CASE WHEN identifier_type = 3 THEN identifier END)) AS identifier FROM patient_identifier GROUP BY person_id""",
)
def identifiers(t: Tables) -> DataFrame:
    return agg.preferred_identifier(t.patient_identifier, "person_id", [("universal", [8]), ("local", [1, 2]), ("study", [3])])


# H: sorts, limits; I: sets


@check(
    "h05_top_k",
    "H5 H4",
    "SELECT person_id, n FROM (SELECT person_id, COUNT(*) AS n FROM encounter GROUP BY person_id) ORDER BY n DESC, person_id LIMIT 50",
)
def top_k(t: Tables) -> DataFrame:
    return t.encounter.groupBy("person_id").agg(F.count(F.lit(1)).alias("n")).orderBy(c("n").desc(), "person_id").limit(50)


@check(
    "h06_dedupe_by_key",
    "H6 P2",
    "SELECT person_id, location_id, MIN(encounter_id) AS encounter_id FROM (SELECT *, RANK() OVER (PARTITION BY person_id, location_id ORDER BY encounter_date) AS r FROM encounter) WHERE r = 1 GROUP BY 1, 2",
)
def dedupe(t: Tables) -> DataFrame:
    df = t.encounter.select("person_id", "location_id", "encounter_date", "encounter_id")
    return agg.earliest_per(df, ["person_id", "location_id"], ["encounter_date", "encounter_id"]).drop("encounter_date")


@check(
    "i01_union_of_event_sources",
    "I1 I3 I7",
    """SELECT person_id, encounter_id, encounter_date, encounter_type, location_id FROM encounter WHERE voided = 0
      UNION ALL SELECT person_id, obs_id + 100000000, CAST(obs_datetime AS DATE), 99999, NULL FROM lab_event""",
)
def event_sources(t: Tables) -> DataFrame:
    enc = live(t.encounter).select("person_id", "encounter_id", "encounter_date", "encounter_type", "location_id")
    labs = t.lab_event.select(
        "person_id",
        (c("obs_id") + 100000000).alias("encounter_id"),
        F.to_date("obs_datetime").alias("encounter_date"),
        F.lit(99999).alias("encounter_type"),
    )
    return enc.unionByName(labs, allowMissingColumns=True)


@check(
    "i02_union_distinct",
    "I2",
    "SELECT person_id, CAST(DATE_TRUNC('month', encounter_date) AS DATE) AS month FROM encounter UNION SELECT person_id, CAST(DATE_TRUNC('month', date_enrolled) AS DATE) FROM patient_program",
)
def union_distinct(t: Tables) -> DataFrame:
    a = t.encounter.select("person_id", d.month_start(c("encounter_date")).alias("month"))
    return a.union(t.patient_program.select("person_id", d.month_start(c("date_enrolled")).alias("month"))).distinct()


@check(
    "i04_aligned_evidence",
    "I4",
    """SELECT person_id, MIN(day) AS first_evidence, STRING_AGG(DISTINCT source, ', ' ORDER BY source) AS sources FROM (SELECT person_id, death_date AS day, 'registry' AS source FROM person WHERE death_date IS NOT NULL
      UNION ALL SELECT person_id, encounter_date, 'encounter' FROM encounter WHERE voided = 1 UNION ALL SELECT person_id, date_completed, 'program' FROM patient_program WHERE program_id = 4 AND date_completed IS NOT NULL) GROUP BY person_id""",
)
def evidence(t: Tables) -> DataFrame:
    parts = [
        t.person.filter("death_date IS NOT NULL").select("person_id", c("death_date").alias("day"), F.lit("registry").alias("source")),
        t.encounter.filter("voided = 1").select("person_id", c("encounter_date").alias("day"), F.lit("encounter").alias("source")),
        t.patient_program.filter("program_id = 4 AND date_completed IS NOT NULL").select(
            "person_id", c("date_completed").alias("day"), F.lit("program").alias("source")
        ),
    ]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return both.groupBy("person_id").agg(F.min("day").alias("first_evidence"), agg.distinct_text(c("source")).alias("sources"))


@check(
    "i05_lists_both_ways",
    "I5 R4",
    """WITH a AS (SELECT DISTINCT person_id FROM encounter WHERE encounter_type = 14), b AS (SELECT DISTINCT person_id FROM patient_program WHERE program_id IN (1, 2))
    SELECT person_id, 'a' AS side FROM a WHERE person_id NOT IN (SELECT person_id FROM b) UNION ALL SELECT person_id, 'b' FROM b WHERE person_id NOT IN (SELECT person_id FROM a)""",
)
def both_ways(t: Tables) -> DataFrame:
    return quality.both_ways(t.encounter.filter("encounter_type = 14"), t.patient_program.filter("program_id IN (1, 2)"), "person_id")


@check(
    "i06_changed_key_union",
    "I6 K3",
    """SELECT person_id FROM encounter WHERE GREATEST(date_created, date_changed, date_voided) >= DATE '2001-07-01'
      UNION SELECT person_id FROM obs WHERE GREATEST(date_created, date_changed, date_voided) >= DATE '2001-07-01'
      UNION SELECT person_id FROM lab_event WHERE GREATEST(date_created, date_changed) >= DATE '2001-07-01'
      UNION SELECT person_id FROM clinical_order WHERE GREATEST(date_activated, date_changed) >= DATE '2001-07-01'
      UNION SELECT person_id FROM person WHERE GREATEST(date_voided, date_changed) >= DATE '2001-07-01'""",
)
def changed_keys(t: Tables) -> DataFrame:
    from caretrail.operators.incremental import changed_persons

    return changed_persons(t, "2001-07-01")


# R: data quality


@check(
    "r01_build_totals",
    "R1",
    """SELECT 'a' AS build, COUNT(*) AS rows, CAST(SUM(encounter_type) AS BIGINT) AS encounter_type, CAST(SUM(location_id) AS BIGINT) AS location_id FROM encounter
      UNION ALL SELECT 'b', COUNT(*), CAST(SUM(encounter_type) AS BIGINT), CAST(SUM(location_id) AS BIGINT) FROM encounter WHERE voided = 0""",
)
def totals(t: Tables) -> DataFrame:
    return quality.build_totals(t.encounter, live(t.encounter), ["encounter_type", "location_id"])


@check(
    "r02_build_differences",
    "R2",
    """SELECT a.encounter_id, CASE WHEN b.encounter_id IS NULL THEN 'only in a' ELSE 'differs' END AS difference FROM encounter a LEFT JOIN (SELECT *, CASE WHEN location_id = 3 THEN NULL ELSE location_id END AS site FROM encounter WHERE voided = 0) b
      ON a.encounter_id = b.encounter_id WHERE b.encounter_id IS NULL OR a.location_id IS DISTINCT FROM b.site""",
)
def differences(t: Tables) -> DataFrame:
    b = live(t.encounter).withColumn("location_id", F.when(c("location_id") != 3, c("location_id")))
    return quality.differences(t.encounter, b, ["encounter_id"], ["location_id"])


@check(
    "r02_differing_columns",
    "R2",
    """SELECT 'location_id' AS column_name, COUNT(CASE WHEN location_id = 3 THEN 1 END) AS differing FROM encounter WHERE voided = 0
      UNION ALL SELECT 'encounter_type', COUNT(CASE WHEN encounter_type <> 1 THEN 1 END) FROM encounter WHERE voided = 0""",
)
def differing(t: Tables) -> DataFrame:
    b = live(t.encounter).withColumn("location_id", F.when(c("location_id") != 3, c("location_id"))).withColumn("encounter_type", F.lit(1))
    return quality.differing_columns(t.encounter, b, ["encounter_id"], ["location_id", "encounter_type"])


@check(
    "r03_repeated_results",
    "R3 R6",
    "SELECT encounter_id, concept_id, COUNT(*) AS copies FROM obs WHERE voided = 0 GROUP BY encounter_id, concept_id HAVING COUNT(*) > 1",
)
def repeated(t: Tables) -> DataFrame:
    return quality.repeated(live(t.obs), ["encounter_id", "concept_id"])


@check(
    "r05_observed_without_summary",
    "R5 H5",
    "SELECT DISTINCT person_id FROM obs WHERE voided = 0 AND person_id NOT IN (SELECT person_id FROM spine WHERE is_clinical = 1)",
)
def no_summary(t: Tables) -> DataFrame:
    summary = encounters(t).filter("is_clinical = 1").select("person_id").distinct()
    return joins.exclude(live(t.obs), summary, ["person_id"]).select("person_id").distinct()


@check("r06_key_uniqueness", "R6", "SELECT encounter_id, COUNT(*) AS copies FROM spine GROUP BY encounter_id HAVING COUNT(*) > 1")
def unique(t: Tables) -> DataFrame:
    return quality.repeated(measured(t), ["encounter_id"])
