"""Flattening observations and reading answers back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretrail.checks.registry import check
from caretrail.functions import obs as enc
from caretrail.functions.obs import Answers
from caretrail.operators import flatten as fl
from caretrail.sources.tables import Tables, live

c = F.col

ORDERED = "ORDER BY concept_id, COALESCE(value_coded, -1), value"
TOKEN = "'!!' || concept_id || '=' || value || '!!'"
DATE_TOKEN = "'!!' || concept_id || '=' || obs_date || '!!'"


@check(
    "b01_typed_value",
    "B1",
    "SELECT concept_id, COUNT(*) AS n, COUNT(value) AS n_values, MIN(value) AS least, MAX(value) AS greatest FROM tall GROUP BY concept_id",
)
def typed(t: Tables) -> DataFrame:
    obs = live(t.obs)
    return obs.select("concept_id", fl.typed_value(obs).alias("v")).groupBy("concept_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("v").alias("n_values"), F.min("v").alias("least"), F.max("v").alias("greatest")
    )


@check(
    "b02_flatten_obs",
    "B2 B3 B4 A1",
    f"""SELECT encounter_id, STRING_AGG({TOKEN}, ' ## ' {ORDERED}) AS obs, STRING_AGG({DATE_TOKEN}, ' ## ' {ORDERED}, obs_date) AS obs_datetimes,
      MAX(obs_date) AS max_obs_date FROM tall WHERE value IS NOT NULL GROUP BY encounter_id""",
)
def flatten_obs(t: Tables) -> DataFrame:
    return fl.flatten(live(t.obs), ["encounter_id"], marks={"max_obs_date": F.max("obs_date")})


@check(
    "b05_flatten_without_encounter",
    "B5 B6",
    """SELECT MIN(obs_id) + 100000000 AS encounter_id, -(MIN(obs_id) + 100000000) AS visit_id, person_id, CAST(obs_datetime AS DATE) AS encounter_date, 99999 AS encounter_type,
      STRING_AGG('!!' || concept_id || '=' || value || '!!', ' ## ' ORDER BY concept_id, value) AS obs
      FROM (SELECT *, CASE WHEN value_numeric = FLOOR(value_numeric) THEN CAST(CAST(value_numeric AS BIGINT) AS VARCHAR) ELSE CAST(value_numeric AS VARCHAR) END AS value FROM lab_event)
      WHERE value IS NOT NULL GROUP BY person_id, obs_datetime""",
)
def without_encounter(t: Tables) -> DataFrame:
    flat = fl.flatten_without_encounter(t.lab_event.withColumn("obs_date", F.to_date("obs_datetime")))
    return flat.select(
        "encounter_id", "visit_id", "person_id", F.to_date("encounter_datetime").alias("encounter_date"), "encounter_type", "obs"
    )


@check(
    "b06_synthetic_visit",
    "B6",
    "SELECT e.encounter_id, COALESCE(v.visit_id, -e.encounter_id) AS visit_id FROM encounter e LEFT JOIN visit v ON v.visit_id = e.encounter_id WHERE e.voided = 0",
)
def synthetic_visit(t: Tables) -> DataFrame:
    visits = t.visit.select(c("visit_id").alias("encounter_id"), c("visit_id"))
    return live(t.encounter).join(visits, "encounter_id", "left").select(
        "encounter_id", fl.visit_or_own(c("visit_id"), c("encounter_id")).alias("visit_id")
    )


LABS = (856, 5497, 1255, 5089)


@check(
    "b07_flatten_lab_day",
    "B7 M3",
    f"""SELECT person_id, obs_date, STRING_AGG({TOKEN}, ' ## ' {ORDERED}) AS obs FROM tall
      WHERE concept_id IN (856, 5497, 1255, 5089) AND NOT (concept_id = 1255 AND value = '1107') AND value IS NOT NULL GROUP BY person_id, obs_date""",
)
def lab_day(t: Tables) -> DataFrame:
    from caretrail.plans.flat_tables import lab_days

    return lab_days(live(t.obs), LABS, none_ordered=(1255, 1107)).select("person_id", "obs_date", "obs")


@check(
    "b08_distinct_flatten",
    "B8",
    f"SELECT person_id, obs_date, STRING_AGG({TOKEN}, ' ## ' {ORDERED}) AS obs FROM (SELECT DISTINCT person_id, obs_date, concept_id, value_coded, value FROM tall WHERE value IS NOT NULL) GROUP BY person_id, obs_date",
)
def distinct_flatten(t: Tables) -> DataFrame:
    return fl.flatten(live(t.obs), ["person_id", "obs_date"], distinct=True).select("person_id", "obs_date", "obs")


@check(
    "b09_provenance",
    "B9",
    """SELECT person_id, obs_date, STRING_AGG('!!' || concept_id || '=' || value_coded || '=' || encounter_id || '!!', ' ## ' ORDER BY concept_id, value_coded, encounter_id) AS encounter_ids
      FROM tall WHERE value_coded IS NOT NULL GROUP BY person_id, obs_date""",
)
def provenance(t: Tables) -> DataFrame:
    coded = live(t.obs).filter("value_coded IS NOT NULL")
    return coded.groupBy("person_id", "obs_date").agg(
        fl.ordered_text(
            [c("concept_id"), c("value_coded"), c("encounter_id")], fl.token(c("concept_id"), c("value_coded"), c("encounter_id"))
        ).alias("encounter_ids")
    )


@check(
    "b10_flatten_orders",
    "B10 M2",
    """SELECT encounter_id, person_id, STRING_AGG(CAST(concept_id AS VARCHAR), ' ## ' ORDER BY concept_id, date_activated) AS orders,
      STRING_AGG('!!' || concept_id || '=' || date_activated || '!!', ' ## ' ORDER BY concept_id, date_activated) AS order_datetimes
      FROM clinical_order GROUP BY encounter_id, person_id""",
)
def orders(t: Tables) -> DataFrame:
    return fl.flatten_orders(t.clinical_order).drop("order_concepts")


@check(
    "b11_flatten_groups",
    "B11",
    f"""WITH g AS (SELECT *, encounter_id * 10 + concept_id % 3 AS obs_group_id, CASE encounter_id % 3 WHEN 0 THEN 7307 WHEN 1 THEN 7334 ELSE 0 END AS group_concept FROM tall),
     p AS (SELECT encounter_id, obs_group_id, STRING_AGG({TOKEN}, ' ## ' ORDER BY concept_id, value) AS part FROM g WHERE group_concept IN (7307, 7334) AND value IS NOT NULL GROUP BY 1, 2)
    SELECT encounter_id, STRING_AGG(part, ' $ ' ORDER BY obs_group_id) AS obs_groups FROM p GROUP BY encounter_id""",
)
def groups(t: Tables) -> DataFrame:
    parent = F.when(c("encounter_id") % 3 == 0, 7307).when(c("encounter_id") % 3 == 1, 7334).otherwise(0)
    obs = live(t.obs).withColumn("obs_group_id", c("encounter_id") * 10 + c("concept_id") % 3).withColumn("group_concept", parent)
    return fl.flatten_groups(obs, [7307, 7334])


@check(
    "b12_pivot_first",
    "B12 M41",
    """SELECT encounter_id, MIN(CASE WHEN concept_id = 856 THEN value_numeric END) AS vl, MIN(CASE WHEN concept_id = 5497 THEN value_numeric END) AS cd4,
      MIN(CASE WHEN concept_id = 5089 THEN value_numeric END) AS weight FROM obs WHERE voided = 0 AND concept_id IN (856, 5497, 5089) GROUP BY encounter_id""",
)
def pivot_first(t: Tables) -> DataFrame:
    return fl.pivot_first(live(t.obs), ["encounter_id"], {"vl": 856, "cd4": 5497, "weight": 5089}, c("value_numeric"))


@check(
    "b13_pivot_all",
    "B13 M40",
    """SELECT person_id, STRING_AGG(CASE WHEN concept_id = 1250 THEN CAST(value_coded AS VARCHAR) END, ' // ' ORDER BY CAST(value_coded AS VARCHAR)) AS drugs,
      STRING_AGG(CASE WHEN concept_id = 1255 THEN CAST(value_coded AS VARCHAR) END, ' // ' ORDER BY CAST(value_coded AS VARCHAR)) AS plans
      FROM obs WHERE voided = 0 AND concept_id IN (1250, 1255) GROUP BY person_id""",
)
def pivot_all(t: Tables) -> DataFrame:
    return fl.pivot_all(live(t.obs), ["person_id"], {"drugs": 1250, "plans": 1255}, c("value_coded").cast("string"))


@check(
    "b14_transpose_numbered",
    "B14",
    """WITH d AS (SELECT DISTINCT person_id, value_coded FROM obs WHERE voided = 0 AND concept_id = 1250),
     n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY person_id ORDER BY value_coded) AS n FROM d)
    SELECT person_id, MAX(CASE WHEN n = 1 THEN value_coded END) AS drug1, MAX(CASE WHEN n = 2 THEN value_coded END) AS drug2, MAX(CASE WHEN n = 3 THEN value_coded END) AS drug3,
     STRING_AGG(CASE WHEN n > 3 THEN CAST(value_coded AS VARCHAR) END, ' ## ' ORDER BY n) AS drugrest FROM n GROUP BY person_id""",
)
def transpose(t: Tables) -> DataFrame:
    drugs = live(t.obs).filter("concept_id = 1250")
    return fl.transpose_numbered(drugs, ["person_id"], c("value_coded"), [c("value_coded")], "drug", 3)


@check(
    "b15_flatten_by_template",
    "B15 D1",
    f"""SELECT t.encounter_id, STRING_AGG({TOKEN}, ' ## ' {ORDERED}) AS obs FROM tall t JOIN encounter e ON e.encounter_id = t.encounter_id
      WHERE e.encounter_type IN (1, 14) AND concept_id IN (1250, 1255, 5096) AND value IS NOT NULL GROUP BY t.encounter_id""",
)
def by_template(t: Tables) -> DataFrame:
    wanted = t.encounter.filter(c("encounter_type").isin(1, 14)).select("encounter_id")
    obs = live(t.obs).join(wanted, "encounter_id", "left_semi")
    return fl.flatten(obs, ["encounter_id"], [1250, 1255, 5096]).select("encounter_id", "obs")


# Reading answers

READ_SQL = {
    "has_drug": "MAX(CASE WHEN concept_id = 1250 THEN 1 ELSE 0 END)",
    "stopped": "MAX(CASE WHEN concept_id = 1255 AND value IN ('1107', '1260') THEN 1 ELSE 0 END)",
    "either": "MAX(CASE WHEN concept_id IN (1250, 1255) AND value IN ('628', '1256') THEN 1 ELSE 0 END)",
    "exact": "MAX(CASE WHEN concept_id = 1250 AND value = '62' THEN 1 ELSE 0 END)",
    "vl_is_number": "MAX(CASE WHEN concept_id = 856 THEN 1 ELSE 0 END)",
    "drug": "MIN(CASE WHEN concept_id = 1250 THEN value END)",
    "drugs": "STRING_AGG(CASE WHEN concept_id = 1250 THEN value END, ' ## ' ORDER BY CASE WHEN concept_id = 1250 THEN value END)",
    "vl": "CAST(MIN(CASE WHEN concept_id = 856 THEN value END) AS DOUBLE)",
    "rtc": "CAST(MIN(CASE WHEN concept_id = 5096 THEN value END) AS DATE)",
}


def _one(flag) -> F.Column:
    return F.when(flag, 1).otherwise(0)


@check(
    "c01_read_answer_map",
    "C1 C2 C3 C4 C5 C6 C9 Z9",
    f"SELECT encounter_id, {', '.join(f'{v} AS {k}' for k, v in READ_SQL.items())} FROM tall GROUP BY encounter_id",
)
def read_map(t: Tables) -> DataFrame:
    obs = live(t.obs)
    tall = obs.select("encounter_id", "concept_id", fl.typed_value(obs).alias("value"), F.lit(None).cast("date").alias("obs_date"))
    a = Answers()
    return fl.answer_map(tall, ["encounter_id"]).select(
        "encounter_id",
        _one(a.asked(1250)).alias("has_drug"),
        _one(a.said(1255, 1107, 1260)).alias("stopped"),
        _one(a.said((1250, 1255), 628, 1256)).alias("either"),
        _one(a.said(1250, 62)).alias("exact"),
        _one(a.is_number(856)).alias("vl_is_number"),
        a.first(1250).alias("drug"),
        a.joined(1250).alias("drugs"),
        a.number(856).alias("vl"),
        a.date(5096).alias("rtc"),
    )


@check(
    "c02_read_encoded_string",
    "C1 C2 C3 C4 C5 C6 C9 L1",
    f"""SELECT encounter_id, {', '.join(f'{v} AS {k}' for k, v in READ_SQL.items() if k != 'drugs')},
      STRING_AGG(CASE WHEN concept_id = 1250 THEN value END, ' ## ' ORDER BY value_coded) AS drugs FROM tall GROUP BY encounter_id""",
)
def read_string(t: Tables) -> DataFrame:
    o = c("obs")
    return fl.flatten(live(t.obs), ["encounter_id"]).select(
        "encounter_id",
        _one(enc.encoded_has(o, 1250)).alias("has_drug"),
        _one(enc.encoded_said(o, [1255], [1107, 1260])).alias("stopped"),
        _one(enc.encoded_said(o, [1250, 1255], [628, 1256])).alias("either"),
        _one(enc.encoded_said(o, [1250], [62])).alias("exact"),
        _one(enc.encoded_is_number(o, 856)).alias("vl_is_number"),
        F.array_min(enc.encoded_values(o, 1250)).alias("drug"),
        enc.encoded_joined(o, 1250).alias("drugs"),
        F.array_min(enc.encoded_values(o, 856)).cast("double").alias("vl"),
        F.array_min(enc.encoded_values(o, 5096)).cast("date").alias("rtc"),
    )


@check(
    "c07_text_key_values",
    "C7 J7",
    """SELECT encounter_id, COALESCE(STRING_AGG(CASE WHEN concept_id = 1250 THEN value || 'mg' END, ' ## ' ORDER BY value || 'mg'), '') AS named,
      '1088=' || STRING_AGG(CASE WHEN concept_id = 1250 THEN value || 'mg' END, ' ## ' ORDER BY value || 'mg') AS formulation
      FROM tall WHERE concept_id IN (1250, 1255) GROUP BY encounter_id""",
)
def text_keys(t: Tables) -> DataFrame:
    from caretrail.functions.regimens import formulation

    obs = live(t.obs).filter(c("concept_id").isin(1250, 1255))
    key = F.when(c("concept_id") == 1250, "1088_drug").otherwise("1255")
    text = F.when(c("concept_id") == 1250, F.concat(c("value_coded").cast("string"), F.lit("mg"))).otherwise(c("value_coded").cast("string"))
    flat = obs.groupBy("encounter_id").agg(fl.ordered_text([key, text], fl.token(key, text)).alias("obs"))
    return flat.select(
        "encounter_id",
        enc.encoded_custom(c("obs"), "1088_drug").alias("named"),
        formulation(enc.encoded_values(c("obs"), "1088_drug")).alias("formulation"),
    )


@check(
    "c08_date_of_answer",
    "C8",
    """SELECT e.encounter_id, COALESCE(MIN(CASE WHEN concept_id = 856 THEN obs_date END), ANY_VALUE(e.encounter_date)) AS vl_date
      FROM encounter e LEFT JOIN obs o ON o.encounter_id = e.encounter_id AND o.voided = 0 AND concept_id = 856 GROUP BY e.encounter_id""",
)
def date_of_answer(t: Tables) -> DataFrame:
    obs = live(t.obs).filter("concept_id = 856").select("encounter_id", "concept_id", F.lit("x").alias("value"), "obs_date")
    answers = fl.answer_map(obs, ["encounter_id"])
    return t.encounter.join(answers, "encounter_id", "left").select(
        "encounter_id", F.coalesce(Answers().first_date(856), c("encounter_date")).alias("vl_date")
    )


@check(
    "c09_lenient_numbers",
    "C9",
    """SELECT p_partkey, TRY_CAST(NULLIF(REGEXP_EXTRACT(p_size || ' ' || p_type, '^\\s*(-?\\d+(?:\\.\\d+)?)', 1), '') AS DOUBLE) AS leading,
      TRY_CAST(NULLIF(REGEXP_EXTRACT(p_name, '^\\s*(-?\\d+(?:\\.\\d+)?)', 1), '') AS DOUBLE) AS nothing FROM part""",
)
def lenient(t: Tables) -> DataFrame:
    return t.raw("part").select(
        "p_partkey",
        enc.lenient_number(F.concat_ws(" ", c("p_size").cast("string"), "p_type")).alias("leading"),
        enc.lenient_number(c("p_name")).alias("nothing"),
    )


WHO_STAGE = [
    ((5356, 8287, 1224, 8307), (1204, 1220), 1),
    ((5356, 8287, 1224, 8307), (1205, 1221), 2),
    ((5356, 8287, 1224, 8307), (1206, 1222), 3),
    ((5356, 8287, 1224, 8307), (1207, 1223), 4),
]
MAP_QUESTIONS = [(5356, "coded", v) for v in (1204, 1205, 1222, 1223)] + [(8288, "coded", v) for v in (6343, 6655, 6656)] + [
    (2022, "coded", v) for v in (1065, 1066, 1067)
]
from caretrail.sources.views import answer_rows_sql  # noqa: E402


@check(
    "c10_answer_code_mapping",
    "C10 C11",
    """SELECT encounter_id,
      CASE WHEN MAX(CASE WHEN concept_id = 5356 AND value = '1204' THEN 1 END) = 1 THEN 1 WHEN MAX(CASE WHEN concept_id = 5356 AND value = '1205' THEN 1 END) = 1 THEN 2
           WHEN MAX(CASE WHEN concept_id = 5356 AND value = '1222' THEN 1 END) = 1 THEN 3 WHEN MAX(CASE WHEN concept_id = 5356 AND value = '1223' THEN 1 END) = 1 THEN 4 END AS who_stage,
      CASE WHEN MAX(CASE WHEN value = '6343' THEN 1 END) = 1 THEN 'GOOD' WHEN MAX(CASE WHEN value = '6655' THEN 1 END) = 1 THEN 'FAIR' WHEN MAX(CASE WHEN value = '6656' THEN 1 END) = 1 THEN 'POOR' END AS adherence,
      CASE WHEN MAX(CASE WHEN value = '1065' THEN 1 END) = 1 THEN 1 WHEN MAX(CASE WHEN value = '1066' THEN 1 END) = 1 THEN 0 END AS fever
      FROM a GROUP BY encounter_id""",
    views={"a": answer_rows_sql(MAP_QUESTIONS)},
)
def code_mapping(t: Tables) -> DataFrame:
    a = Answers()
    return fl.answer_map(t.answers(MAP_QUESTIONS), ["encounter_id"]).select(
        "encounter_id",
        a.map_codes(WHO_STAGE).alias("who_stage"),
        a.map_codes([(8288, (6343,), "GOOD"), (8288, (6655,), "FAIR"), (8288, (6656,), "POOR")]).alias("adherence"),
        a.map_codes([(2022, (1065,), 1), (2022, (1066,), 0)]).alias("fever"),
    )


@check(
    "c13_orders_contain",
    "C12 C13 C14 E1 E2",
    """SELECT e.encounter_id, CASE WHEN COUNT(CASE WHEN o.concept_id = 856 THEN 1 END) > 0 THEN 1 ELSE 0 END AS vl_ordered,
      COALESCE(STRING_AGG(DISTINCT CAST(o.concept_id AS VARCHAR), ' ## ' ORDER BY CAST(o.concept_id AS VARCHAR)), '') AS tests_ordered
      FROM encounter e LEFT JOIN clinical_order o ON o.encounter_id = e.encounter_id GROUP BY e.encounter_id""",
)
def orders_contain(t: Tables) -> DataFrame:
    flat = fl.flatten_orders(t.clinical_order).select("encounter_id", "order_concepts")
    return t.encounter.join(flat, "encounter_id", "left").select(
        "encounter_id",
        F.when(F.array_contains("order_concepts", 856), 1).otherwise(0).alias("vl_ordered"),
        F.coalesce(F.array_join(F.array_sort(F.transform("order_concepts", lambda x: x.cast("string"))), " ## "), F.lit("")).alias("tests_ordered"),
    )


@check(
    "c_round_trip",
    "C1 C6",
    "SELECT encounter_id, CAST(concept_id AS VARCHAR) AS concept, value FROM tall WHERE value IS NOT NULL",
)
def round_trip(t: Tables) -> DataFrame:
    flat = fl.flatten(live(t.obs), ["encounter_id"])
    return flat.select("encounter_id", F.explode(enc.encoded_answers(c("obs"))).alias("p")).select("encounter_id", "p.concept", "p.value")
