"""Timeline operators: previous and next values, carries, latches, counters, shift registers, state machines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretrail.checks.registry import check
from caretrail.operators import fold
from caretrail.operators.aggregates import earliest_per, latest_per, running_total
from caretrail.operators.timeline import (
    Timeline,
    by_timeline,
    carry,
    ever,
    following,
    last_results,
    latch,
    locf,
    next_where,
    prev,
    prev_where,
    running,
)
from caretrail.plans.spine import measured
from caretrail.sources.tables import Tables

W = "PARTITION BY person_id ORDER BY encounter_date, day_rank, encounter_id"
UPTO = f"({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
BEFORE = f"({W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
AFTER = f"({W} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
W = f"({W})"


def walk(t: Tables, build, columns: list[str]) -> DataFrame:
    return by_timeline(measured(t), build, t.hot_persons, tasks=t.tasks()).select("encounter_id", *columns)


def simple(name: str, ids: str, looks: dict, sql: dict[str, str]):
    """Register looks on the spine against window SQL of the same column names."""
    body = ", ".join(f"{v} AS {k}" for k, v in sql.items())

    @check(name, ids, f"SELECT encounter_id, {body} FROM spine")
    def run(t: Tables, looks=looks) -> DataFrame:
        made = {k: v() for k, v in looks.items()}
        return walk(t, lambda df, line: line.scan(df, **made), list(looks))


c = F.col
CLINICAL = lambda: c("is_clinical") == 1

simple(
    "g01_previous_value",
    "G1 H1 Z16",
    {
        "prev_type": lambda: prev(c("encounter_type")),
        "prev_date": lambda: prev(c("encounter_date")),
        "prev_rtc": lambda: prev(c("rtc_date")),
    },
    {"prev_type": f"LAG(encounter_type) OVER {W}", "prev_date": f"LAG(encounter_date) OVER {W}", "prev_rtc": f"LAG(rtc_date) OVER {W}"},
)
simple(
    "g02_next_value",
    "G2 H2",
    {"next_type": lambda: following(c("encounter_type")), "next_date": lambda: following(c("encounter_date"))},
    {"next_type": f"LEAD(encounter_type) OVER {W}", "next_date": f"LEAD(encounter_date) OVER {W}"},
)
simple(
    "g03_carry_forward",
    "G3",
    {"cur_vl": lambda: locf(c("vl")), "cur_weight": lambda: locf(c("weight")), "cur_drug": lambda: locf(c("drug"))},
    {k: f"LAST_VALUE({v} IGNORE NULLS) OVER {UPTO}" for k, v in {"cur_vl": "vl", "cur_weight": "weight", "cur_drug": "drug"}.items()},
)


@check(
    "g04_carry_with_clear",
    "G4 N11",
    f"""WITH marked AS (SELECT *, CASE WHEN plan IN (1107, 1260) OR drug IS NOT NULL THEN 1 ELSE 0 END AS event,
      CASE WHEN plan IN (1107, 1260) THEN NULL ELSE drug END AS new_drug FROM spine),
     grouped AS (SELECT *, SUM(event) OVER {UPTO} AS grp FROM marked)
    SELECT encounter_id, MAX(CASE WHEN event = 1 THEN new_drug END) OVER (PARTITION BY person_id, grp) AS cur_drug FROM grouped WHERE grp > 0
    UNION ALL SELECT encounter_id, NULL FROM grouped WHERE grp = 0""",
)
def carry_with_clear(t: Tables) -> DataFrame:
    stop = F.coalesce(c("plan").isin(1107, 1260), F.lit(False))
    look = carry(stop | c("drug").isNotNull(), F.when(~stop, c("drug")))
    return walk(t, lambda df, line: line.scan(df, cur_drug=look), ["cur_drug"])


@check(
    "g05_carry_while_valid",
    "G5",
    f"""WITH carried AS (SELECT *, LAST_VALUE(rtc_date IGNORE NULLS) OVER {UPTO} AS known FROM spine)
    SELECT encounter_id, CASE WHEN rtc_date IS NOT NULL THEN rtc_date WHEN known > encounter_date THEN known END AS cur_rtc_date FROM carried""",
)
def carry_while_valid(t: Tables) -> DataFrame:
    def build(df, line):
        df = line.scan(df, known=locf(c("rtc_date")))
        valid = F.when(c("known") > c("encounter_date"), c("known"))
        return df.withColumn("cur_rtc_date", F.coalesce(c("rtc_date"), valid))

    return walk(t, build, ["cur_rtc_date"])


simple(
    "g06_latch_first_event",
    "G6",
    {
        "first_drug": lambda: latch(c("drug").isNotNull(), c("drug")),
        "first_drug_date": lambda: latch(c("drug").isNotNull(), c("encounter_date")),
        "enrolled": lambda: latch(c("encounter_type") != 21, c("encounter_date")),
    },
    {
        "first_drug": f"FIRST_VALUE(drug IGNORE NULLS) OVER {UPTO}",
        "first_drug_date": f"FIRST_VALUE(CASE WHEN drug IS NOT NULL THEN encounter_date END IGNORE NULLS) OVER {UPTO}",
        "enrolled": f"FIRST_VALUE(CASE WHEN encounter_type <> 21 THEN encounter_date END IGNORE NULLS) OVER {UPTO}",
    },
)


@check(
    "g07_latch_with_correction",
    "G7",
    f"""WITH first AS (SELECT *, FIRST_VALUE(CASE WHEN drug IS NOT NULL THEN CASE WHEN plan = 1256 THEN encounter_date ELSE DATE '1900-01-01' END END IGNORE NULLS) OVER {UPTO} AS latched FROM spine),
     better AS (SELECT *, FIRST_VALUE(CASE WHEN latched = DATE '1900-01-01' AND vl_date IS NOT NULL AND plan = 1257 THEN vl_date END IGNORE NULLS) OVER {UPTO} AS corrected FROM first)
    SELECT encounter_id, COALESCE(corrected, latched) AS arv_start_date FROM better""",
)
def latch_with_correction(t: Tables) -> DataFrame:
    def build(df, line):
        unknown = F.lit("1900-01-01").cast("date")
        first = F.when(c("plan") == 1256, c("encounter_date")).otherwise(unknown)
        df = line.scan(df, latched=latch(c("drug").isNotNull(), first))
        better = (c("latched") == unknown) & c("vl_date").isNotNull() & (c("plan") == 1257)
        df = line.scan(df, corrected=latch(better, c("vl_date")))
        return df.withColumn("arv_start_date", F.coalesce("corrected", "latched"))

    return walk(t, build, ["arv_start_date"])


@check(
    "g08_same_day_sticky",
    "G8",
    """SELECT encounter_id, LAST_VALUE(vl IGNORE NULLS) OVER (PARTITION BY person_id, encounter_date ORDER BY day_rank, encounter_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS vl_resulted FROM spine""",
)
def same_day_sticky(t: Tables) -> DataFrame:
    line = Timeline(["person_id", "encounter_date"], ["day_rank", "encounter_datetime", "encounter_id"])
    return line.scan(measured(t), vl_resulted=locf(c("vl"))).select("encounter_id", "vl_resulted")


simple(
    "g09_previous_clinical",
    "G9",
    {"prev_clinical": lambda: prev_where(CLINICAL(), c("encounter_date")), "prev_clinical_rtc": lambda: prev_where(CLINICAL() & c("rtc_date").isNotNull(), c("rtc_date"))},
    {
        "prev_clinical": f"LAST_VALUE(CASE WHEN is_clinical = 1 THEN encounter_date END IGNORE NULLS) OVER {BEFORE}",
        "prev_clinical_rtc": f"LAST_VALUE(CASE WHEN is_clinical = 1 THEN rtc_date END IGNORE NULLS) OVER {BEFORE}",
    },
)
simple(
    "g10_next_clinical",
    "G10",
    {"next_clinical": lambda: next_where(CLINICAL(), c("encounter_date")), "next_clinical_location": lambda: next_where(CLINICAL(), c("location_id"))},
    {
        "next_clinical": f"FIRST_VALUE(CASE WHEN is_clinical = 1 THEN encounter_date END IGNORE NULLS) OVER {AFTER}",
        "next_clinical_location": f"FIRST_VALUE(CASE WHEN is_clinical = 1 THEN location_id END IGNORE NULLS) OVER {AFTER}",
    },
)


@check(
    "g11_event_between_clinical_visits",
    "G11",
    f"""WITH seg AS (SELECT *, SUM(is_clinical) OVER {UPTO} AS segment FROM spine),
     ev AS (SELECT person_id, segment, MAX(encounter_date) AS event_date FROM seg WHERE is_clinical = 0 AND encounter_type = 21 GROUP BY 1, 2)
    SELECT s.encounter_id, e.event_date AS outreach_date_bncd FROM seg s LEFT JOIN ev e ON e.person_id = s.person_id AND e.segment = s.segment WHERE s.is_clinical = 1""",
)
def between_clinical_visits(t: Tables) -> DataFrame:
    from caretrail.plans.hiv_summary import events_until_next_clinical

    def build(df, line):
        return events_until_next_clinical(df, line, {"outreach_date_bncd": (c("encounter_type") == 21, c("encounter_date"))})

    return by_timeline(measured(t), build, t.hot_persons, tasks=t.tasks()).filter("is_clinical = 1").select("encounter_id", "outreach_date_bncd")


simple(
    "g12_running_counter",
    "G12 F14",
    {"visit_num": lambda: running(F.when(~c("encounter_type").isin(5, 6, 7, 8, 9, 21), 1).otherwise(0))},
    {"visit_num": f"CAST(SUM(CASE WHEN encounter_type NOT IN (5, 6, 7, 8, 9, 21) THEN 1 ELSE 0 END) OVER {UPTO} AS BIGINT)"},
)


@check(
    "g12_distinct_visit_number",
    "G12",
    "SELECT encounter_id, DENSE_RANK() OVER (PARTITION BY person_id ORDER BY encounter_date) AS visit_day_num FROM spine",
)
def distinct_visit_number(t: Tables) -> DataFrame:
    def build(df, line):
        df = line.scan(df, before=prev(c("encounter_date")))
        fresh = F.when(c("before").isNull() | (c("before") != c("encounter_date")), 1).otherwise(0)
        return line.scan(df.withColumn("fresh", fresh), visit_day_num=running(c("fresh")))

    return walk(t, build, ["visit_day_num"])


@check(
    "g13_shift_register",
    "G13",
    f"""WITH r AS (SELECT person_id, encounter_id, encounter_date, day_rank, vl, vl_date,
       LAG(vl, 1) OVER {W} AS v2, LAG(vl_date, 1) OVER {W} AS d2, LAG(vl, 2) OVER {W} AS v3, LAG(vl_date, 2) OVER {W} AS d3,
       LAG(vl, 3) OVER {W} AS v4, LAG(vl_date, 3) OVER {W} AS d4, ROW_NUMBER() OVER {W} AS n FROM spine WHERE vl IS NOT NULL),
     s AS (SELECT s.*, COUNT(s.vl) OVER {UPTO} AS n FROM spine s)
    SELECT s.encounter_id, r.vl AS vl_1, r.vl_date AS vl_1_date, r.v2 AS vl_2, r.d2 AS vl_2_date, r.v3 AS vl_3, r.d3 AS vl_3_date, r.v4 AS vl_4, r.d4 AS vl_4_date
    FROM s LEFT JOIN r ON r.person_id = s.person_id AND r.n = s.n""",
)
def shift_register(t: Tables) -> DataFrame:
    names = [f"vl_{i}{s}" for i in range(1, 5) for s in ("", "_date")]
    return walk(t, lambda df, line: last_results(df, line, c("vl").isNotNull(), c("vl"), c("vl_date"), "vl", 4), names)


def daily_results(df: DataFrame) -> DataFrame:
    """One row per person and day: the laboratory result (type 116 stands for it) and the form result."""
    lab = c("encounter_type") == 116
    return (
        df.filter("vl IS NOT NULL")
        .groupBy("person_id", c("encounter_date").alias("day"))
        .agg(
            F.max(F.when(lab, c("vl"))).alias("lab_value"),
            F.max_by(F.when(~lab, c("vl")), F.when(~lab, F.struct("vl_date", "vl"))).alias("form_value"),
            F.max(F.when(~lab, c("vl_date"))).alias("form_date"),
        )
    )


@check(
    "g14_guarded_results",
    "G14",
    """WITH RECURSIVE d AS (SELECT person_id, encounter_date AS day, MAX(CASE WHEN encounter_type = 116 THEN vl END) AS lab,
       MAX(CASE WHEN encounter_type <> 116 THEN vl_date END) AS fdate,
       ARG_MAX(CASE WHEN encounter_type <> 116 THEN vl END, CASE WHEN encounter_type <> 116 THEN {'d': vl_date, 'v': vl} END) AS form,
       ROW_NUMBER() OVER (PARTITION BY person_id ORDER BY encounter_date) AS n
       FROM spine WHERE vl IS NOT NULL GROUP BY person_id, encounter_date),
     st AS (SELECT person_id, n, day, COALESCE(lab, form) AS v1, CASE WHEN lab IS NOT NULL THEN day ELSE fdate END AS d1, CAST(NULL AS DOUBLE) AS v2, CAST(NULL AS DATE) AS d2 FROM d WHERE n = 1
      UNION ALL
      SELECT x.person_id, x.n, x.day,
       CASE WHEN lab IS NOT NULL THEN lab WHEN ABS(fdate - d1) > 30 AND fdate > d1 THEN form ELSE v1 END,
       CASE WHEN lab IS NOT NULL THEN x.day WHEN ABS(fdate - d1) > 30 AND fdate > d1 THEN fdate ELSE d1 END,
       CASE WHEN (lab IS NOT NULL AND x.day <> d1) OR (lab IS NULL AND ABS(fdate - d1) > 30 AND fdate > d1) THEN v1 ELSE v2 END,
       CASE WHEN (lab IS NOT NULL AND x.day <> d1) OR (lab IS NULL AND ABS(fdate - d1) > 30 AND fdate > d1) THEN d1 ELSE d2 END
      FROM st JOIN d x ON x.person_id = st.person_id AND x.n = st.n + 1)
    SELECT person_id, day, v1 AS value_1, d1 AS date_1, v2 AS value_2, d2 AS date_2 FROM st""",
)
def guarded_results(t: Tables) -> DataFrame:
    return fold.accepted_results(daily_results(measured(t)), ["person_id"], block=F.year("day") if t.hot_persons else None)


@check(
    "g14_pregnancy_state",
    "G14 J18",
    """WITH RECURSIVE d AS (SELECT s.person_id, encounter_date AS day, MAX(CASE WHEN encounter_type = 14 THEN 1 ELSE 0 END) AS start,
       MAX(CASE WHEN plan = 1260 THEN 1 ELSE 0 END) AS stop, MIN(CASE WHEN vl_date IS NOT NULL THEN vl_date + 280 END) AS due,
       ROW_NUMBER() OVER (PARTITION BY s.person_id ORDER BY encounter_date) AS n
       FROM spine s JOIN person p ON p.person_id = s.person_id AND gender = 'F' GROUP BY s.person_id, encounter_date),
     r AS (SELECT person_id, n, day, CASE WHEN stop = 1 THEN 0 WHEN start = 1 THEN 1 ELSE 0 END AS preg,
        CASE WHEN stop = 0 AND start = 1 THEN due END AS edd FROM d WHERE n = 1
      UNION ALL
      SELECT x.person_id, x.n, x.day,
       CASE WHEN x.stop = 1 THEN 0 WHEN x.start = 1 THEN 1 WHEN x.day - edd > 28 THEN 0 ELSE preg END,
       CASE WHEN x.stop = 0 AND (x.start = 1 OR (preg = 1 AND COALESCE(x.day - edd, 0) <= 28))
            THEN COALESCE(CASE WHEN preg = 1 AND COALESCE(x.day - edd, 0) <= 28 THEN edd END, due) END
      FROM r JOIN d x ON x.person_id = r.person_id AND x.n = r.n + 1)
    SELECT person_id, day, preg AS is_pregnant, edd FROM r""",
)
def pregnancy_state(t: Tables) -> DataFrame:
    women = t.person.filter("gender = 'F'").select("person_id")
    daily = (
        measured(t)
        .join(women, "person_id", "left_semi")
        .groupBy("person_id", c("encounter_date").alias("day"))
        .agg(
            (F.max(F.when(c("encounter_type") == 14, 1).otherwise(0)) == 1).alias("start"),
            (F.max(F.when(c("plan") == 1260, 1).otherwise(0)) == 1).alias("stop"),
            F.min(F.date_add("vl_date", 280)).alias("due"),
        )
    )
    return fold.pregnancy(daily, ["person_id"])


@check(
    "g15_change_detection",
    "G15 N13",
    f"""WITH x AS (SELECT *, LAST_VALUE(CASE WHEN is_clinical = 1 THEN location_id END IGNORE NULLS) OVER {BEFORE} AS pl,
       FIRST_VALUE(CASE WHEN is_clinical = 1 THEN location_id END IGNORE NULLS) OVER {AFTER} AS nl FROM spine)
    SELECT encounter_id, CASE WHEN pl <> location_id THEN 1 ELSE 0 END AS transfer_in, CASE WHEN nl <> location_id THEN 1 ELSE 0 END AS transfer_out FROM x""",
)
def change_detection(t: Tables) -> DataFrame:
    from caretrail.operators.rules import moved

    def build(df, line):
        df = line.scan(
            df, before=prev_where(CLINICAL(), c("location_id")), after=next_where(CLINICAL(), c("location_id"))
        )
        return df.withColumn("transfer_in", moved(c("location_id"), c("before"))).withColumn(
            "transfer_out", moved(c("location_id"), c("after"))
        )

    return walk(t, build, ["transfer_in", "transfer_out"])


@check(
    "g16_location_hold",
    "G16",
    f"""WITH x AS (SELECT s.*, v.visit_type_id FROM spine s LEFT JOIN visit v ON v.visit_id = s.encounter_id)
    SELECT encounter_id, LAST_VALUE(CASE WHEN COALESCE(visit_type_id, 0) NOT IN (23, 119) THEN location_id END IGNORE NULLS) OVER {UPTO} AS held_location_id FROM x""",
)
def location_hold(t: Tables) -> DataFrame:
    df = measured(t).join(t.visit.select(c("visit_id").alias("encounter_id"), "visit_type_id"), "encounter_id", "left")
    held = F.coalesce(c("visit_type_id"), F.lit(0)).isin(23, 119)
    look = carry(~held, c("location_id"))
    return by_timeline(df, lambda d, line: line.scan(d, held_location_id=look), t.hot_persons, tasks=t.tasks()).select(
        "encounter_id", "held_location_id"
    )


@check(
    "g17_previous_next_by_program",
    "G17",
    """WITH x AS (SELECT *, CASE WHEN encounter_type IN (1, 2, 14) THEN 1 ELSE 2 END AS program_id FROM spine)
    SELECT encounter_id, program_id, LAG(encounter_date) OVER w AS prev_program_date, LEAD(encounter_date) OVER w AS next_program_date, LAG(rtc_date) OVER w AS prev_program_rtc
    FROM x WINDOW w AS (PARTITION BY person_id, program_id ORDER BY encounter_date, day_rank, encounter_id)""",
)
def by_program(t: Tables) -> DataFrame:
    df = measured(t).withColumn("program_id", F.when(c("encounter_type").isin(1, 2, 14), 1).otherwise(2))
    looks = dict(
        prev_program_date=prev(c("encounter_date")),
        next_program_date=following(c("encounter_date")),
        prev_program_rtc=prev(c("rtc_date")),
    )
    out = by_timeline(df, lambda d, line: line.scan(d, **looks), t.hot_persons, key=("person_id", "program_id"), tasks=t.tasks())
    return out.select("encounter_id", "program_id", *looks)


simple(
    "g18_baseline_latch",
    "G18",
    {"active_at_baseline": lambda: ever((c("encounter_date") <= F.lit("1998-10-31").cast("date")) & (c("rtc_date") > F.lit("1998-10-31").cast("date")))},
    {"active_at_baseline": f"MAX(CASE WHEN encounter_date <= DATE '1998-10-31' AND rtc_date > DATE '1998-10-31' THEN 1 ELSE 0 END) OVER {UPTO}"},
)


@check(
    "g19_transition_flags",
    "G19",
    f"""WITH x AS (SELECT *, CASE WHEN LEAD(encounter_date) OVER {W} > rtc_date + 30 THEN 'late' WHEN rtc_date IS NULL THEN 'unknown' ELSE 'kept' END AS status FROM spine)
    SELECT encounter_id, status, LAG(status) OVER {W} AS prev_status, CASE WHEN status = 'kept' AND LAG(status) OVER {W} = 'late' THEN 1 ELSE 0 END AS returned FROM x""",
)
def transitions(t: Tables) -> DataFrame:
    def build(df, line):
        df = line.scan(df, after=following(c("encounter_date")))
        status = F.when(c("after") > F.date_add("rtc_date", 30), "late").when(c("rtc_date").isNull(), "unknown").otherwise("kept")
        df = line.scan(df.withColumn("status", status), prev_status=prev(c("status")))
        return df.withColumn("returned", F.when((c("status") == "kept") & (c("prev_status") == "late"), 1).otherwise(0))

    return walk(t, build, ["status", "prev_status", "returned"])


@check(
    "g20_running_total",
    "G20",
    """WITH m AS (SELECT location_id, CAST(DATE_TRUNC('month', encounter_date) AS DATE) AS month, COUNT(*) AS n FROM spine GROUP BY 1, 2)
    SELECT location_id, month, n, CAST(SUM(n) OVER (PARTITION BY location_id ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total FROM m""",
)
def cumulative(t: Tables) -> DataFrame:
    monthly = measured(t).groupBy("location_id", F.trunc("encounter_date", "month").cast("date").alias("month")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return running_total(monthly, "n", ["location_id"], ["month"], "total")


@check(
    "g21_first_and_last_row",
    "G21 H3 F11 H6",
    """WITH r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY person_id ORDER BY encounter_date, day_rank, encounter_id) AS n,
      ROW_NUMBER() OVER (PARTITION BY person_id ORDER BY encounter_date DESC, day_rank DESC, encounter_id DESC) AS back FROM spine)
    SELECT person_id, MAX(CASE WHEN n = 1 THEN encounter_id END) AS first_encounter, MAX(CASE WHEN back = 1 THEN encounter_id END) AS last_encounter,
      MAX(CASE WHEN back = 1 THEN location_id END) AS last_location FROM r GROUP BY person_id""",
)
def first_and_last(t: Tables) -> DataFrame:
    df = measured(t).select("person_id", "encounter_date", "day_rank", "encounter_id", "location_id")
    order = ["encounter_date", "day_rank", "encounter_id"]
    first = earliest_per(df, ["person_id"], order).select("person_id", c("encounter_id").alias("first_encounter"))
    last = latest_per(df, ["person_id"], order).select(
        "person_id", c("encounter_id").alias("last_encounter"), c("location_id").alias("last_location")
    )
    return first.join(last, "person_id")


simple(
    "g22_carry_ignoring_zero",
    "G22",
    {"cur_weight": lambda: locf(F.when(c("weight") != 60, c("weight"))), "cur_cd4": lambda: locf(F.when(c("cd4") != 0, c("cd4")))},
    {
        "cur_weight": f"LAST_VALUE(CASE WHEN weight <> 60 THEN weight END IGNORE NULLS) OVER {UPTO}",
        "cur_cd4": f"LAST_VALUE(CASE WHEN cd4 <> 0 THEN cd4 END IGNORE NULLS) OVER {UPTO}",
    },
)
