"""Flat tables: observations, orders, laboratory days, typed laboratory rows, vitals and nutrition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretrail.functions.obs import Answers, lenient_number
from caretrail.operators.flatten import flatten, flatten_orders
from caretrail.sources.tables import Tables, live

# Concepts of laboratory results and orders.
LAB_CONCEPTS = (
    856, 5497, 730, 21, 653, 790, 12, 1030, 1040, 1271, 9239, 9020, 9508, 6126, 887, 6252, 1537, 857, 679, 851, 1018,
    1017, 1016, 729, 678, 1330, 1132, 1133, 1134, 655, 1297, 6123, 654, 717, 848, 785, 1014, 10249, 10250, 10251, 9010,
    9011, 9699, 9012, 9812, 10304, 10313, 8731, 8595, 1984, 2339, 6337, 7276, 2340, 9307, 1327, 8732, 8733, 8734, 8735,
    10195, 10196, 10197, 6342, 9434, 9590, 7423, 885,
)

# Typed columns of a laboratory row. 'int' is a whole number, a pair a decimal, 'text' all values joined.
LAB_COLUMNS: list[tuple[str, int, object]] = [
    ("hiv_dna_pcr", 1030, "int"),
    ("hiv_rapid_test", 1040, "int"),
    ("hiv_viral_load", 856, "int"),
    ("cd4_count", 5497, "int"),
    ("cd4_percent", 730, (3, 1)),
    ("chest_xray", 12, "int"),
    ("hba1c", 6126, (4, 1)),
    ("rbs", 887, (4, 1)),
    ("fbs", 6252, (4, 1)),
    ("ecg", 1537, "int"),
    ("urea", 857, (4, 1)),
    ("rbc", 679, (6, 2)),
    ("hemoglobin", 21, (6, 2)),
    ("mcv", 851, "int"),
    ("mch", 1018, (6, 2)),
    ("mchc", 1017, (6, 2)),
    ("rdw", 1016, (6, 2)),
    ("plt", 729, "int"),
    ("wbc", 678, (6, 2)),
    ("anc", 1330, (6, 2)),
    ("creatinine", 790, (6, 2)),
    ("na", 1132, (6, 2)),
    ("k", 1133, (6, 2)),
    ("cl", 1134, (6, 2)),
    ("total_bili", 655, (6, 2)),
    ("direct_bili", 1297, (6, 2)),
    ("ggt", 6123, (6, 2)),
    ("ast", 653, (6, 2)),
    ("alt", 654, (6, 2)),
    ("total_protein", 717, (6, 2)),
    ("albumin", 848, (6, 2)),
    ("alk_phos", 785, (6, 2)),
    ("ldh", 1014, (6, 2)),
    ("total_psa", 10249, (6, 2)),
    ("cea", 10250, (6, 2)),
    ("ca_19_9", 10251, (6, 2)),
    ("hbf", 9010, (6, 2)),
    ("hba", 9011, (6, 2)),
    ("hbs", 9699, (6, 2)),
    ("hba2", 9012, (6, 2)),
    ("serum_crag", 9812, (6, 2)),
    ("gene_expert_image", 10304, "text"),
    ("dst_image", 10313, "text"),
    ("serum_m_protein", 8595, "text"),
    ("spep", 8731, "text"),
    ("pus_c_urine", 1984, "text"),
    ("protein_urine", 2339, "int"),
    ("leuc", 6337, "text"),
    ("ketone", 7276, "text"),
    ("sugar_urine", 2340, "text"),
    ("nitrites", 9307, "text"),
    ("retic", 1327, (5, 2)),
    ("a_1_glob", 8732, (5, 2)),
    ("a_2_glob", 8733, (5, 2)),
    ("beta_glob", 8734, (5, 2)),
    ("gamma_glob", 8735, (5, 2)),
    ("kappa_l_c", 10195, (5, 2)),
    ("lambda_l_c", 10196, (5, 2)),
    ("ratio_l_c", 10197, (5, 2)),
    ("pap_smear", 885, "int"),
    ("hpv", 2322, "int"),
]
LAB_ERRORS = {"vl_error": 856, "cd4_error": 5497, "hiv_dna_pcr_error": 1030}

# Vital signs.
VITAL_COLUMNS: list[tuple[str, int, object]] = [
    ("weight", 5089, (4, 1)),
    ("height", 5090, (4, 1)),
    ("temp", 5088, (4, 1)),
    ("oxygen_sat", 5092, "int"),
    ("systolic_bp", 5085, "int"),
    ("diastolic_bp", 5086, "int"),
    ("pulse", 5087, "int"),
    ("bsa", 980, "int"),
    ("ecog", 6584, "int"),
    ("inr", 8167, "int"),
    ("lcc", 8898, "int"),
    ("rcc", 8899, "int"),
]

# Nutrition measures and the labels of diagnosis answers.
NUTRITION_COLUMNS: list[tuple[str, int, object]] = [
    ("weight", 5089, (4, 1)),
    ("height", 5090, (4, 1)),
    ("weight_height_zscore", 8238, (4, 1)),
    ("h_l_for_age_zscore", 9816, (4, 1)),
    ("muac_value", 1343, (4, 1)),
    ("bmi", 1342, "text"),
]
NUTRITION_LABELS: dict[str, tuple[int, dict[int, str]]] = {
    "weight_height_zscore_diagnosis": (
        10213,
        {1115: "Normal", 10277: "Mild acute malnutrition", 9472: "Moderate acute malnutrition", 9471: "Severe acute malnutrition"},
    ),
    "h_l_for_age_zscore_diagnosis": (
        10214,
        {1115: "Normal", 10226: "Mild stunting", 10216: "Moderate stunting", 10217: "Severe stunting"},
    ),
    "muac_diagnosis": (
        10225,
        {10224: "Normal", 10222: "Moderate acute malnutrition", 10223: "Severe acute malnutrition"},
    ),
}


def typed(a: Answers, concept: int, kind: object) -> Column:
    """Answer of a concept in its column type."""
    if kind == "text":
        return a.joined(concept)
    number = lenient_number(a.first(concept))
    if kind == "int":
        return F.floor(number).cast("bigint")
    precision, scale = kind
    return F.round(number, scale).try_cast(f"decimal({precision},{scale})").cast("double")


def flat_obs(t: Tables, keys: DataFrame | None = None) -> DataFrame:
    """One row per encounter with its encoded observations, their dates and the newest source date."""
    obs = live(t.obs)
    if keys is not None:
        obs = obs.join(keys.select("person_id"), "person_id", "left_semi")
    flat = flatten(obs, ["encounter_id"], marks={"max_date_created": F.max("obs_date")})
    head = live(t.encounter).select("person_id", "encounter_id", "encounter_date", "encounter_type", "location_id")
    return head.join(flat, "encounter_id")


def flat_orders(t: Tables) -> DataFrame:
    return flatten_orders(t.clinical_order)


def lab_days(obs: DataFrame, concepts=LAB_CONCEPTS, none_ordered: tuple[int, int] = (1271, 1107)) -> DataFrame:
    """One row per person and day of laboratory observations. Orders answered "none" are left out."""
    concept, code = none_ordered
    none = F.coalesce((F.col("concept_id") == concept) & (F.col("value_coded") == code), F.lit(False))
    return flatten(obs.filter(~none), ["person_id", "obs_date"], concepts)


def lab_rows(answers: DataFrame, orders: DataFrame, key: list[str]) -> DataFrame:
    """Wide typed laboratory row per key with error flags and the tests ordered."""
    a = Answers()
    coded = F.coalesce(a.values(1271), F.array().cast("array<string>"))
    ordered = F.coalesce(F.transform("order_concepts", lambda x: x.cast("string")), F.array().cast("array<string>"))
    via = F.coalesce(a.first(9434), a.first(9590))
    return answers.join(orders, key, "left").select(
        *key,
        *[typed(a, concept, kind).alias(name) for name, concept, kind in LAB_COLUMNS if name != "chest_xray"],
        F.when(~a.said(12, 1107), typed(a, 12, "int")).alias("chest_xray"),
        lenient_number(via).cast("bigint").alias("via_or_via_vili"),
        a.joined(9239).alias("has_errors"),
        *[F.when(a.said(9239, code), 1).alias(name) for name, code in LAB_ERRORS.items()],
        F.array_join(F.array_sort(F.array_union(coded, ordered)), " ## ").alias("tests_ordered"),
    )


def labs_and_orders_by_day(labs: DataFrame, orders: DataFrame) -> DataFrame:
    """Laboratory days and order days of a person side by side, also where only one of them exists."""
    return labs.join(orders, ["person_id", "test_date"], "full_outer")


def vitals(answers: DataFrame) -> DataFrame:
    a = Answers()
    return answers.select(
        "encounter_id", "person_id", "encounter_date", "location_id", *[typed(a, k, kind).alias(n) for n, k, kind in VITAL_COLUMNS]
    )


def nutrition(answers: DataFrame) -> DataFrame:
    a = Answers()
    labels = []
    for name, (concept, table) in NUTRITION_LABELS.items():
        labels.append(a.joined(concept).alias(f"{name}_coded"))
        labels.append(a.map_codes([(concept, (code,), label) for code, label in table.items()]).alias(f"{name}_value"))
    return answers.select("encounter_id", "person_id", *[typed(a, k, kind).alias(n) for n, k, kind in NUTRITION_COLUMNS], *labels)

