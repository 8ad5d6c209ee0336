"""Datasets over pivoted columns: one column per concept, then the same timeline operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretrail.operators.aggregates import preferred_identifier
from caretrail.operators.flatten import pivot_all, pivot_first
from caretrail.operators.joins import with_attributes
from caretrail.operators.newest import last_keys
from caretrail.operators.timeline import Passes, by_timeline, following, locf, next_where, prev, running
from caretrail.plans.spine import encounters
from caretrail.sources.tables import Tables

c = F.col

# Single and multiple answer columns of the domain pivots.
DOMAINS: dict[str, dict[str, dict[str, int]]] = {
    "drug": {
        "first": {
            "pcp_prophy_current": 1109, "crypto_tx_current": 1112, "pcp_prophy_plan": 1261, "pcp_prophy_started": 1263,
            "crypto_tx_plan": 1277, "crypto_tx": 1278, "on_septrin": 2250,
        },
        "all": {
            "current_meds": 1193, "meds_used_past_three_months": 1637, "missed_med_reason": 1668, "toxicity": 1879, "med_added": 1895, "oi_prophy_drug": 8346,
        },
    },
    "arvs": {"first": {"arv_plan": 1255, "arvs_started": 1250, "adherence": 8288}, "all": {"arvs_current": 1088, "arvs_per_patient": 2154, "arvs_past": 2157}},
    "tb": {"first": {"tb_plan": 1268, "tb_prophy_plan": 1265, "tb_prophy_stopped": 1266, "tb_started": 1270}, "all": {"tb_drugs": 1111, "tb_test_ordered": 1271}},
    "maternity": {"first": {"pregnant": 8351, "delivered": 1156, "family_planning": 374}, "all": {"family_planning_method": 7240, "feeding": 1151}},
    "peds": {"first": {"feeding_now": 1151, "mother_alive": 9601, "immunised": 8586}, "all": {"infant_drugs": 1187, "pcr": 1030}},
    "external": {"first": {"ext_rapid_test": 1040, "ext_dna_pcr": 1030, "ext_chest_xray": 12}, "all": {"ext_tests": 1271}},
    "history_and_physical": {"first": {"who_stage": 5356, "who_stage_peds": 1224, "disclosed": 6596}, "all": {"problems": 6042, "findings": 1120}},
    "retention": {"first": {"transfer_care": 1285, "reason_exited_care": 1596, "discontinue_is_hiv_neg": 1946, "programme_status": 9082}, "all": {"arv_meds": 1088, "arv_meds_plan": 1250}},
}


def domain_questions(domain: str) -> list[tuple[int, str, int]]:
    """Stand-in answers for a domain's questions."""
    concepts = sorted({k for kind in DOMAINS[domain].values() for k in kind.values()})
    return [(k, "coded", 1000 + (k * 7 + i * 13) % 90) for k in concepts for i in range(3)]


def domain_pivot(t: Tables, domain: str) -> DataFrame:
    """One row per encounter with a column per concept of a domain."""
    spec = DOMAINS[domain]
    answers = t.answers(domain_questions(domain))
    single = pivot_first(answers, ["encounter_id"], spec["first"], c("value"))
    many = pivot_all(answers, ["encounter_id"], spec["all"], c("value"))
    return single.join(many, "encounter_id", "full_outer")


MOH_QUESTIONS = (
    [(5096, "date", 0)] * 4
    + [(1255, "coded", k) for k in (1256, 1107, 1260, 1257)]
    + [(1250, "coded", k) for k in (6964, 794)]
    + [(1088, "coded", k) for k in (6467, 628)]
    + [(2154, "coded", 630), (1285, "coded", 1287), (1946, "coded", 1065), (1040, "coded", 664), (1040, "coded", 703), (9082, "coded", 9068)]
)


def moh_indicators(t: Tables) -> DataFrame:
    """Care indicators from pivoted answer columns: visits, return dates, treatment dates and regimen, transfers."""
    columns = {"arv_plan": 1255, "arv_started": 1250, "arvs_current": 1088, "arvs_per_patient": 2154, "transfer_care": 1285, "neg": 1946, "rapid": 1040, "care": 9082}
    answers = t.answers(MOH_QUESTIONS)
    codes = pivot_first(answers, ["encounter_id"], columns, c("value").try_cast("int"))
    dates = pivot_first(answers, ["encounter_id"], {"rtc": 5096}, F.try_to_date("value", "yyyy-MM-dd"))
    rows = encounters(t).join(codes, "encounter_id", "left").join(dates, "encounter_id", "left")

    def build(part: DataFrame, line) -> DataFrame:
        today = c("encounter_date")
        stop = F.coalesce(c("arv_plan").isin(1107, 1260), F.lit(False))
        begin = F.coalesce(c("arv_plan") == 1256, F.lit(False))
        any_drug = F.coalesce("arv_started", "arvs_current", "arvs_per_patient")
        negative = F.coalesce((c("neg") == 1065) | (c("rapid") == 664), F.lit(False))
        positive = F.coalesce(c("rapid") == 703, F.lit(False)) | any_drug.isNotNull() | c("arv_plan").isNotNull()
        p = Passes()
        p.look(0, visit_num=running(F.when(~c("encounter_type").isin(5, 6, 7, 8, 9, 21), 1).otherwise(0)), cur_rtc_date=locf(c("rtc")))
        p.set_or_soft(0, "hiv_start_date", F.lit(False), today, positive, today, negative)
        p.set_or_soft(0, "arv_start_date", begin, today, any_drug.isNotNull(), today, stop & ~begin)
        p.set_or_soft(0, "cur_arv_meds", any_drug.isNotNull() & ~stop, any_drug, F.lit(False), any_drug, stop)
        p.look(1, prev_rtc_date=prev(c("cur_rtc_date")))
        return p.run(line, part)

    away = c("transfer_care").isin(1287, 9068) | c("care").isin(1287, 9068)
    return by_timeline(rows, build, t.hot_persons, tasks=t.tasks()).select(
        "person_id", "encounter_id", "encounter_date", "visit_num", "prev_rtc_date", "cur_rtc_date", F.when(away, 1).alias("transfer_out"), "hiv_start_date", "arv_start_date", "cur_arv_meds"
    )


def retention(t: Tables) -> DataFrame:
    """Retention rows: return date, next appointment and clinic visit, identifiers, phone and usual health centre."""
    questions = [(5096, "date", 0)] * 3 + [(1502, "date", 0), (1777, "date", 0), (1285, "coded", 1287), (1596, "coded", 1594), (9082, "coded", 6101)]
    answers = t.answers(questions)
    is_rtc = c("concept_id").isin(5096, 1502, 1777)
    wide = answers.groupBy("encounter_id").agg(
        F.min(F.when(is_rtc, F.try_to_date("value", "yyyy-MM-dd"))).alias("rtc_date"),
        *[F.min(F.when(c("concept_id") == k, c("value").try_cast("int"))).alias(n) for n, k in (("transfer_care", 1285), ("reason_exited_care", 1596), ("programme_status", 9082))],
    )
    rows = encounters(t).join(wide, "encounter_id", "left")
    looks = dict(
        next_appt_date=following(c("encounter_date")),
        next_encounter_type=following(c("encounter_type")),
        next_hiv_clinic_date=next_where(c("is_clinical") == 1, c("encounter_date")),
        prev_rtc_date=prev(c("rtc_date")),
    )
    df = by_timeline(rows, lambda x, line: line.scan(x, **looks), t.hot_persons, tasks=t.tasks())
    ids = preferred_identifier(t.patient_identifier, "person_id", [("universal", [8]), ("local", [3]), ("study", [7])]).select("person_id", "identifier")
    visits = encounters(t).groupBy("person_id", "location_id").agg(F.count(F.lit(1)).alias("n"))
    visits = visits.select("person_id", c("n").cast("int"), (-c("location_id")).alias("least"))
    usual = last_keys(visits, ["person_id"], ["n", "least"]).select("person_id", (-c("least")).alias("health_center"))
    df = with_attributes(df.join(ids, "person_id", "left").join(usual, "person_id", "left"), t.person_attribute, {"phone_number": 10})
    return df.select(
        "person_id", "encounter_id", "encounter_date", "rtc_date", "prev_rtc_date", "next_appt_date", "next_encounter_type", "next_hiv_clinic_date",
        "transfer_care", "reason_exited_care", "programme_status", "identifier", "health_center", "phone_number",
    )
