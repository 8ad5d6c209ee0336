"""Classification rules with their thresholds as parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caretrail.functions.dates import months_between, years_between

# Days after the return date at which a status starts, per report.
MONTHLY_CUTS = [(30, "active"), (90, "defaulter")]
WEEKLY_CUTS = [(0, "active"), (4, "missed"), (28, "defaulter")]
CARE_MODEL_CUTS = [(28, "active"), (90, "defaulter")]
PREP_CUTS = [(0, "active"), (30, "defaulter")]


def effective_return(rtc: Column, seen: Column, grace: int = 30) -> Column:
    """The return date, or a grace period after the visit where none was given."""
    return F.coalesce(rtc, F.date_add(seen, grace))


def status_by_days(late: Column, cuts: list[tuple[int, str]], beyond: str = "ltfu") -> Column:
    """Status by days late; a cut is the last day of its status."""
    out = F.when(late.isNull(), F.lit("unknown"))
    for last, name in cuts:
        out = out.when(late <= last, F.lit(name))
    return out.otherwise(F.lit(beyond))


def care_status(
    end: Column, seen: Column, rtc: Column, death: Column, transfer_out: Column, cuts: list[tuple[int, str]], start: Column
) -> Column:
    """Status at a period end: death and transfer before the period first, then days since the return date."""
    late = F.datediff(end, effective_return(rtc, seen))
    return (
        F.when(death < start, F.lit("dead"))
        .when(transfer_out < start, F.lit("transfer_out"))
        .otherwise(status_by_days(late, cuts))
    )


def suppressed(value: Column, limit: int = 1000, inclusive: bool = False) -> Column:
    return value <= limit if inclusive else value < limit


def visit_adherence(seen: Column, due: Column, end: Column, window: int = 0) -> Column:
    """How a visit met its schedule: on time, early, late; missed when it did not happen by the period end."""
    return (
        F.when(due.isNull() & seen.isNotNull(), F.lit("unscheduled"))
        .when(seen.isNull() & (due <= end), F.lit("missed"))
        .when(seen.isNull(), F.lit("not due"))
        .when(F.abs(F.datediff(seen, due)) <= window, F.lit("on schedule"))
        .when(seen < due, F.lit("early"))
        .otherwise(F.lit("late"))
    )


def vl_due(end: Column, art_start: Column, vl_1: Column, vl_1_date: Column, vl_2: Column, limit: int = 1000) -> dict[str, Column]:
    """Whether a viral load is due at a period end, why, and for how many months it has been."""
    on_art = months_between(art_start, end)
    since = months_between(vl_1_date, end)
    follow_up = (vl_1 > limit) & (vl_1_date > art_start) & since.between(3, 11)
    first = on_art.between(6, 11) & vl_1.isNull()
    second = on_art.between(12, 18) & vl_2.isNull()
    yearly = (on_art >= 12) & F.coalesce(since >= 12, F.lit(True))
    rules = [
        (follow_up, "Previous VL Unsuppressed", since - 3),
        (first, "On ART for 6 months", on_art - 6),
        (second, "On ART for 12 months", on_art - 12),
        (yearly, "Annual VL", months_between(F.coalesce(vl_1_date, art_start), end) - 12),
    ]
    reason = months = None
    for test, name, wait in rules:
        reason = F.when(test, name) if reason is None else reason.when(test, name)
        months = F.when(test, wait) if months is None else months.when(test, wait)
    return {
        "due_for_vl": F.when(reason.isNotNull(), 1).otherwise(0),
        "reason_for_needing_vl": reason,
        "months_needed_vl": months,
    }


def follow_up_vl(end: Column, vl_1: Column, vl_1_date: Column, vl_2: Column, vl_2_date: Column, start: Column, limit: int = 1000) -> dict[str, Column]:
    """Follow-up chain after an unsuppressed result."""
    qualifies = ((vl_1 >= limit) & months_between(vl_1_date, end).between(3, 12)) | (
        (vl_2 >= limit) & months_between(vl_2_date, end).between(3, 12)
    )
    qualifies = F.coalesce(qualifies, F.lit(False))
    got = F.coalesce(qualifies & (months_between(vl_2_date, vl_1_date) < 12), F.lit(False))
    now = got & F.coalesce(vl_1_date.between(start, end), F.lit(False))
    bit = lambda c: F.when(c, 1).otherwise(0)
    return {
        "qualifies_for_follow_up_vl": bit(qualifies),
        "got_follow_up_vl": bit(got),
        "got_follow_up_vl_this_month": bit(now),
        "num_days_to_follow_vl": F.when(got, F.datediff(vl_1_date, vl_2_date)),
        "follow_up_vl_suppressed": bit(got & (vl_1 < limit)),
        "follow_up_vl_suppressed_this_month": bit(now & (vl_1 < limit)),
        "follow_up_vl_unsuppressed": bit(got & (vl_1 >= limit)),
        "follow_up_vl_unsuppressed_this_month": bit(now & (vl_1 >= limit)),
    }


def art_cohort(end: Column, first_start: Column, status: Column) -> dict[str, Column]:
    """Months on treatment, the anniversary cohort and the net twelve-month cohort."""
    number = F.when(
        (status != "transfer_out") & (F.month(first_start) == F.month(end)), years_between(first_start, end)
    )
    return {
        "art_cohort_total_months": months_between(first_start, end),
        "art_cohort_num": number,
        "net_12_month_cohort_this_month": F.when((status != "transfer_out") & (number == 1), 1).otherwise(0),
    }


def differentiated_care(age: Column, months_on_art: Column, vl: Column, vl_age_days: Column, bmi: Column, pregnant: Column, limit: int = 400) -> Column:
    """Stable on treatment: adult, a year on it, recently suppressed, not underweight, not pregnant."""
    ok = (age >= 20) & (months_on_art >= 12) & (vl <= limit) & (vl_age_days <= 365) & (F.coalesce(bmi, F.lit(18.5)) >= 18.5)
    return F.when(F.coalesce(ok & (F.coalesce(pregnant, F.lit(0)) == 0), F.lit(False)), 1).otherwise(0)


def within_months(flag: Column, seen: Column, end: Column, months: int) -> Column:
    return F.when((flag == 1) & (months_between(seen, end) <= months), 1).otherwise(0)


def moved(here: Column, other: Column) -> Column:
    """1 when two known locations differ."""
    return F.when(here.isNotNull() & other.isNotNull() & (here != other), 1).otherwise(0)


# Encounter types of clinical visits, those gated by visit type, and the rank of types within a day.
CLINICAL_TYPES = (
    1, 2, 3, 4, 10, 14, 15, 17, 19, 26, 32, 33, 34, 47, 105, 106, 112, 113, 114, 117, 120, 127, 128, 138, 140, 153, 154,
    158, 162, 163,
)
GATED_TYPE, NOT_CLINICAL_VISITS = 186, (24, 25, 80, 104)
RANKED_CLINICAL_TYPES = CLINICAL_TYPES + (115, 186, 212)
TRANSIT_VISIT = 24


def is_clinical(encounter_type: Column, visit_type: Column | None = None) -> Column:
    gated = F.lit(False)
    if visit_type is not None:
        gated = (encounter_type == GATED_TYPE) & visit_type.isNotNull() & ~visit_type.isin(*NOT_CLINICAL_VISITS)
    return F.when(encounter_type.isin(*CLINICAL_TYPES) | gated, 1).otherwise(0)


def day_rank(encounter_type: Column) -> Column:
    """Order of encounters of one day: triage-like first, clinical late, the final consultation last."""
    return (
        F.when(encounter_type == 116, 20).when(encounter_type.isin(*RANKED_CLINICAL_TYPES), 10).when(encounter_type == 129, 5).otherwise(1)
    )


def is_transit(visit_type: Column) -> Column:
    return F.when(visit_type == TRANSIT_VISIT, 1).when(visit_type.isNotNull(), 0)
