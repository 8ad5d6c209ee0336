"""Aggregate reports: indicators by site and period, appointment and data-entry performance, outreach, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretrail.functions import dates as d
from caretrail.operators.aggregates import bucket_counts, conditional_counts, indicator_counts, ratio, running_total
from caretrail.operators.timeline import by_timeline, following, next_where, prev
from caretrail.plans.hiv_summary import hiv_summary
from caretrail.plans.spine import encounters, last_visits, measured
from caretrail.sources.tables import Tables, live

c = F.col


# Care indicators by site

CARE_COLUMNS = [
    "person_id", "encounter_date", "encounter_type", "known_location", "cur_arv_line", "vl_value_1", "vl_date_1", "vl_resulted",
    "vl_order_date", "arv_start_date", "edd",
]


def care_indicators() -> dict[str, Column]:
    """Indicator name and test, in terms of the summary's columns."""
    seen, vl, vl_on, art = c("encounter_date"), c("vl_value_1"), c("vl_date_1"), c("arv_start_date")
    weeks = lambda a: d.complete_units("week", a, seen)
    months = lambda a: d.months_between(a, seen)
    on_arvs = c("cur_arv_line").isNotNull()
    recent = weeks(vl_on) <= 52
    return {
        "num_patients": F.lit(True),
        "on_arvs": on_arvs,
        "on_arvs_first_line": c("cur_arv_line") == 1,
        "on_arvs_second_line": c("cur_arv_line") == 2,
        "on_arvs_third_line": c("cur_arv_line") > 2,
        "vl_done_past_year": recent,
        "no_vl_in_past_year": on_arvs & (vl_on.isNull() | (weeks(vl_on) >= 52)),
        "vl_done_past_year_lte_1000": recent & (vl <= 1000),
        "vl_done_past_year_gt_1000": recent & (vl > 1000),
        "vl_done_this_encounter": c("vl_resulted") >= 0,
        "vl_done_this_encounter_lte_1000": c("vl_resulted") <= 1000,
        "vl_done_this_encounter_gt_1000": c("vl_resulted") > 1000,
        "vl_ordered": c("vl_order_date") == seen,
        "pending_vl_order": (weeks(c("vl_order_date")) >= 0) & (vl_on < c("vl_order_date")),
        "pending_vl_order_no_result_after_4_weeks": (weeks(c("vl_order_date")) >= 4) & (vl_on < c("vl_order_date")),
        "on_arvs_lte_26_weeks": weeks(art) <= 26,
        "on_arvs_lte_52_weeks": weeks(art) <= 52,
        "on_arvs_lte_52_weeks_and_have_vl": (weeks(art) <= 52) & recent,
        "on_arvs_lte_52_weeks_and_have_vl_lte_1000": (weeks(art) <= 52) & recent & (vl <= 1000),
        "num_pregnant": c("edd") > seen,
        "num_pregnant_and_on_arvs": (c("edd") > seen) & on_arvs,
        "arv_start_btwn_six_and_twelve_months": months(art).between(6, 12),
        "arv_start_lte_six_months_and_no_vl": months(art).between(6, 12) & (vl_on.isNull() | (months(vl_on) < 3)),
        "arv_start_gte_one_year": months(art) > 12,
        "arv_start_gte_one_year_and_no_vl": (months(art) > 12) & (vl_on.isNull() | (d.years_between(vl_on, seen) > 1)),
    }


def care_rows(t: Tables, start: str, end: str) -> DataFrame:
    """Summary rows of the patients seen in a period, with site and county."""
    rows = hiv_summary(t, columns=CARE_COLUMNS).filter(
        c("encounter_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")) & ~c("encounter_type").isin(21, 99999)
    )
    return rows.withColumnRenamed("known_location", "location_id").join(t.location.select("location_id", "county"), "location_id")


def care_by_site(t: Tables, start: str, end: str) -> DataFrame:
    """Distinct patients per indicator by county and site seen in a period, with subtotals."""
    rows = care_rows(t, start, end)
    return indicator_counts(rows, care_indicators(), ["county", "location_id"], rollup=True)


# Appointments by day


def appointment_performance(t: Tables) -> DataFrame:
    """Per local day: patients who came and how that met their schedule, and patients scheduled and whether they came."""
    df = measured(t)
    df = by_timeline(
        df,
        lambda x, line: line.scan(
            x, prev_rtc=prev(c("rtc_date")), next_clinic=next_where(c("is_clinical") == 1, c("encounter_date")), next_type=following(c("encounter_type"))
        ),
        t.hot_persons,
        tasks=t.tasks(),
    )
    came = F.datediff("encounter_date", "prev_rtc")
    waited = F.datediff("next_clinic", "rtc_date")
    attended = indicator_counts(
        df.filter("encounter_type <> 21").withColumn("d", c("encounter_date")),
        {"attended": F.lit(True), "attended_within_14": F.abs(came) <= 14, "attended_after_14": came > 14},
        ["d"],
    )
    scheduled = indicator_counts(
        df.filter("rtc_date IS NOT NULL").withColumn("d", c("rtc_date")),
        {
            "scheduled": F.lit(True),
            "scheduled_and_attended": c("next_clinic").isNotNull(),
            "has_not_returned": c("next_clinic").isNull(),
            "scheduled_and_attended_within_14": F.abs(waited) <= 14,
            "scheduled_and_attended_after_14": waited > 14,
            "next_visit_by_outreach": c("next_type") == 21,
        },
        ["d"],
    )
    return attended.join(scheduled, "d")


# Data entry

# Encounter types counted by name.
TYPE_NAMES = {"adult_initial": 1, "adult_return": 2, "child_visit": 14, "outreach": 21, "triage": 116}


def entry_by_provider(t: Tables) -> DataFrame:
    """Encounters per provider and type."""
    providers = live(t.encounter_provider).select("encounter_id", "provider_id")
    return live(t.encounter).join(providers, "encounter_id").groupBy("provider_id", "encounter_type").agg(F.count(F.lit(1)).alias("n"))


def entry_by_day(t: Tables) -> DataFrame:
    """Encounters and patients per day and kind, next to the visits opened that day."""
    kinds = {"triage": 116, "adult": 2}
    rows = live(t.encounter).filter("encounter_type <> 21").withColumnRenamed("encounter_date", "day")
    counts = conditional_counts(rows, {**{n: c("encounter_type") == k for n, k in kinds.items()}, "all_encounters": F.lit(True)}, ["day"])
    patients = indicator_counts(rows, {f"{n}_patients": c("encounter_type") == k for n, k in kinds.items()}, ["day"])
    visits = t.visit.withColumnRenamed("date_started", "day").withColumn("visits", F.lit(1))
    per_patient = visits.groupBy("day", "person_id").agg(F.sum("visits").alias("v"))
    opened = per_patient.groupBy("day").agg(F.sum("v").alias("visits"), F.count(F.lit(1)).alias("visit_patients"))
    return counts.join(patients, "day").join(opened, "day")


def entry_timeliness(t: Tables) -> DataFrame:
    """Encounters by site and month, by type, and the share entered in time."""
    df = t.encounter.join(t.location.select("location_id", "name"), "location_id")
    df = df.withColumn("year", F.year("encounter_date")).withColumn("month", F.month("encounter_date"))
    in_time = d.timely(c("date_created"), c("encounter_date"))
    tests = {"total": F.lit(True), **{n: c("encounter_type") == k for n, k in TYPE_NAMES.items()}, **{f"total_{n}": v for n, v in in_time.items()}}
    out = conditional_counts(df, tests, ["name", "year", "month"])
    for n in in_time:
        share = c(f"total_{n}") / c("total")
        out = out.withColumn(f"perc_{n}", F.round(share, 4)).withColumn(f"{n}_gte_95", F.when(share >= 0.95, 1).otherwise(0))
    return out


# Outreach


def outreach_performance(t: Tables) -> DataFrame:
    """Outreach workers: forms, days, forms per day, patients who came back, and subtotals by county."""
    df = encounters(t)
    df = by_timeline(df, lambda x, line: line.scan(x, next_clinic=next_where(c("is_clinical") == 1, c("encounter_date")), next_type=following(c("encounter_type"))), t.hot_persons, tasks=t.tasks())
    forms = df.filter("encounter_type = 21").join(t.location.select("location_id", "county"), "location_id")
    back = F.when(c("next_clinic").isNotNull() & (c("next_type") != 21), 1).otherwise(0)
    per_day = forms.withColumn("back", back).groupBy("county", "location_id", "encounter_date").agg(
        F.count(F.lit(1)).alias("forms"), F.sum("back").alias("returned")
    )

    def totals(keys: list[str]) -> DataFrame:
        days = per_day.groupBy(*keys, "encounter_date").agg(F.sum("forms").alias("forms"), F.sum("returned").alias("returned"))
        return days.groupBy(*keys).agg(F.sum("forms").alias("forms"), F.count(F.lit(1)).alias("days"), F.sum("returned").alias("returned"))

    sites = totals(["county", "location_id"])
    counties = totals(["county"]).select("county", F.lit(None).cast("int").alias("location_id"), "forms", "days", "returned")
    out = sites.unionByName(counties)
    return out.select(
        "*", ratio(c("forms"), c("days")).alias("forms_per_day"), ratio(c("returned"), c("forms"), 1, 100.0).alias("pct_returned")
    )


def lost_by_month(t: Tables, as_of: str) -> DataFrame:
    """Patients lost after their last clinical visit, by site and month of that visit, with the running total of the site."""
    today = F.lit(as_of).cast("date")
    last = last_visits(measured(t), encounters(t).filter("is_clinical = 1"))
    lost = last.filter(F.datediff(today, "rtc_date") > 90).withColumn("month", d.month_start(c("encounter_date")))
    monthly = lost.groupBy("location_id", "month").agg(F.count(F.lit(1)).alias("monthly_ltfu"))
    return running_total(monthly, "monthly_ltfu", ["location_id"], ["month"], "total_ltfu_to_date")


def lost_at(t: Tables, as_of: str, late: int = 90, grace: int = 30) -> DataFrame:
    """Patients lost at a date: the row in force then, overdue, alive; and how many of them were on treatment."""
    today = F.lit(as_of).cast("date")
    last = last_visits(measured(t), encounters(t).filter(c("encounter_date") <= today)).join(t.person.select("person_id", "death_date"), "person_id")
    due = F.coalesce("rtc_date", F.date_add("encounter_date", grace))
    lost = last.filter((F.datediff(today, due) >= late) & F.coalesce(c("death_date") >= today, F.lit(True)))
    return lost.groupBy("location_id").agg(F.count(F.lit(1)).alias("num_ltfu"), F.count("drug").alias("num_ltfu_on_arvs"))


# Days between the return date and the visit.
RETURN_BUCKETS = {
    "on_day": (0, 0), "d1_7": (1, 7), "d1_14": (1, 14), "d1_30": (1, 30), "d8_30": (8, 30), "d14_30": (14, 30),
    "after_7": (8, 100_000), "after_14": (15, 100_000), "after_30": (31, 100_000), "early": (-100_000, -1),
}


def return_distribution(t: Tables) -> DataFrame:
    """How many days late patients return, in overlapping intervals, by year."""
    rows = measured(t).filter("is_clinical = 1")
    rows = by_timeline(rows, lambda x, line: line.scan(x, next_clinic=following(c("encounter_date"))), t.hot_persons, tasks=t.tasks())
    rows = rows.withColumn("year", F.year("encounter_date"))
    out = bucket_counts(rows, F.datediff("next_clinic", "rtc_date"), RETURN_BUCKETS, ["year"])
    known = rows.groupBy("year").agg(F.count("rtc_date").alias("with_rtc"))
    out = out.join(known, "year")
    return out.withColumn("pct_within_30", ratio(c("d1_30") + c("on_day"), c("with_rtc"), 1, 100.0))


def persistent_viraemia(t: Tables, limit: float = 1000.0, apart: int = 90) -> DataFrame:
    """Patients with unsuppressed results, with two of them far enough apart, and of those the ones who changed line."""
    columns = ["person_id", "cur_arv_line", "prev_arv_line", "vl_value_1", "vl_date_1", "vl_value_2", "vl_date_2", "arv_start_date"]
    rows = hiv_summary(t, columns=columns).filter("vl_value_1 IS NOT NULL AND arv_start_date IS NOT NULL")
    high = (c("vl_value_1") >= limit) & (c("vl_value_2") >= limit) & (F.datediff("vl_date_1", "vl_date_2") >= apart)
    tests = {
        "num_patients": F.lit(True),
        "num_unsuppressed": c("vl_value_1") >= limit,
        "persistent": high,
        "arv_change": high & (c("prev_arv_line") == 1) & (c("cur_arv_line") == 2),
    }
    return indicator_counts(rows.withColumn("scope", F.lit("all")), tests, ["scope"])
