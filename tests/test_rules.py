"""Rules of single forms and facts, against values written by hand."""

import pytest
from pyspark.sql import functions as F

from caretrail.functions.regimens import CHEMO
from caretrail.operators.facts import extract_packed
from caretrail.plans.hiv_facts import EXCLUDING, FACTS
from caretrail.plans.hiv_summary import of_patients
from caretrail.specs.blocks import EXAM, changed
from caretrail.specs.forms import FORMS

BY_NAME = {f.name: {q.column: q for q in f.questions} for f in FORMS.values()}


def number(form, column, code):
    return dict(BY_NAME[form][column].answers).get(code)


@pytest.mark.parametrize(
    ("form", "column", "concept", "code", "expected"),
    [
        ("general_oncology_treatment", "general_exam", 1119, 8999, 6),
        ("general_oncology_treatment", "general_exam", 1119, 991, 7),
        ("general_oncology_treatment", "chest", 1123, 5209, 8),
        ("general_oncology_treatment", "urogenital", 1126, 6261, 12),
        ("general_oncology_treatment", "urogenital", 1126, 8261, None),
        ("general_oncology_treatment", "extremities", 1127, 582, 6),
        ("general_oncology_treatment", "nodal_survey", 1121, 161, 4),
        ("general_oncology_treatment", "nodal_survey", 1121, 8261, None),
        ("breast_cancer_treatment", "chest", 1123, 1115, 2),
        ("breast_cancer_treatment", "chest", 1123, 1118, None),
        ("breast_cancer_treatment", "neurologic", 1129, 6005, None),
        ("breast_cancer_treatment", "lesions_laterality", 8264, 5141, 2),
        ("breast_cancer_treatment", "lesions_laterality", 8264, 2399, None),
        ("breast_cancer_treatment", "breast_finding_location", 9696, 9625, None),
        ("lung_cancer_treatment", "neurologic", 1129, 5108, 5),
        ("lung_cancer_treatment", "neurologic", 1129, 6005, None),
        ("lung_cancer_screening", "imaging_results", 12, 5622, 3),
    ],
)
def test_answers_of_a_form(form, column, concept, code, expected):
    assert BY_NAME[form][column].concept == concept and number(form, column, code) == expected


def test_hormone_years_read_their_own_question():
    assert BY_NAME["breast_cancer_screening"]["hrt_use_years"].concept == 9629


def test_lenalidomide_is_one_code():
    assert {name: need for name, need, _ in CHEMO}["RCD"] == (8480, 7203, 7207)


def test_changed_block_keeps_other_lines():
    lines = changed(EXAM, chest="1123 1115").splitlines()
    assert "chest 1123 1115" in lines and len(lines) == len(EXAM.strip().splitlines())
    with pytest.raises(ValueError, match="no such"):
        changed(EXAM, nose="1 2")


# Answers of an outreach visit, and whether the call reached the person (1), failed (2) or is not known.
CALLS = [
    ({(9063, 1065), (9600, 1065)}, 1), ({(1569, 1555), (9600, 1065)}, 1), ({(1558, 1555), (9600, 1065)}, 1), ({(1558, 1555), (1559, 1065)}, 1),
    ({(9063, 1065), (9600, 1066)}, 2), ({(9063, 1560), (9600, 1066)}, 2), ({(9063, 9064), (9600, 1066)}, 2), ({(9063, 9065), (9600, 1066)}, 2),
    ({(9063, 9066), (9600, 1066)}, 2), ({(9063, 5622), (9600, 1066)}, 2), ({(1558, 1555), (9600, 1066)}, 2), ({(1558, 1555), (1559, 1066)}, 2),
    ({(9063, 1560), (9600, 1065)}, None), ({(9063, 1065)}, None), ({(9600, 1066)}, None), ({(1569, 1555), (9600, 1066)}, None),
]


def test_phone_outreach(spark):
    from caretrail.operators.facts import extract_facts, fill_absent
    from caretrail.plans.hiv_summary import phone_outreach

    names = [n for n in FACTS if n.startswith(("phone_", "home_"))]
    facts = {n: FACTS[n] for n in names}
    rows = [(i, concept, code) for i, (answers, _) in enumerate(CALLS) for concept, code in answers]
    obs = spark.createDataFrame([(i, c, str(v)) for i, c, v in rows], "encounter_id int, concept_id int, value string")
    df = fill_absent(extract_facts(obs, ["encounter_id"], facts), facts)
    out = dict(df.select("encounter_id", phone_outreach().alias("p")).where(F.col("encounter_id").isNotNull()).collect())
    assert [out[i] for i in range(len(CALLS))] == [expected for _, expected in CALLS]


OBS = "!!1250=630!! ## !!1250=633!! ## !!10=8480!! ## !!10=7203!! ## !!10=7207!! ## !!20=9614!! ## !!20=9615!! ## !!1088_drug=A!! ## !!1088_drug=B!!"


@pytest.mark.parametrize(
    ("call", "expected"),
    [
        ("convert_to_title_case('mARY-jane o\\'neil (2ND)')", "Mary-Jane O'Neil (2nd)"),
        ("replace_arv_concept_ids('630 ## 6964 ## 9759')", "628 ## 633 ## 797 ## 802 ## 9759"),
        ("get_arv_concept_ids('%s', 1250)", "628 ## 633 ## 797"),
        ("get_moh_arv_code('628 ## 633 ## 797', 30, 1)", "AF1B"),
        ("get_moh_arv_code('628 ## 633 ## 797', 3, 1)", "CF1B"),
        ("get_moh_arv_code('1', 12, 1)", "adult unknown"),
        ("get_moh_arv_code('628 ## 633 ## 797', CAST(NULL AS INT), 1)", None),
        ("normalize_arvs_drug_formulation('%s')", "1088=A ## B"),
        ("normalize_arvs_drug_formulation('!!1=2!!')", None),
        ("normalize_chemo_drugs('%s', '10')", "RD ## RCD"),
        ("normalize_pmtct_arvs('%s', '20')", "9615 ## 9614"),
        ("normalize_arvs('%s', '1250')", "628 ## 633 ## 797"),
        ("get_arv_names('628 ## 633 ## 797')", "3TC ## EFV ## AZT"),
        ("get_custom_values('%s', '1088_drug')", "A ## B"),
        ("split_str('a ## b', ' ## ', 2)", "b"),
        ("get_values('%s', 77)", None),
    ],
)
def test_sql_functions(spark, call, expected):
    from caretrail.functions.registered import FUNCTIONS, register

    register(spark)
    assert len(FUNCTIONS) == 12
    assert spark.sql(f"SELECT {call % OBS if '%s' in call else call}").first()[0] == expected


def test_summary_leaves_out_visits_of_persons_not_known_infected(spark):
    facts = {n: FACTS[n] for n in EXCLUDING}
    told = [(1, 5303, "664"), (2, 5303, "703"), (3, 9082, "9036"), (4, 9082, "1287"), (5, 5303, "822"), (6, 5303, "1067"), (6, 5303, "703"), (7, 5303, "6640")]
    answers = spark.createDataFrame(told, "encounter_id int, concept_id int, value string").withColumn("obs_date", F.current_date())
    events = spark.range(1, 9).select(F.col("id").cast("int").alias("encounter_id"))
    kept = of_patients(events.join(extract_packed(answers, ["encounter_id"], facts), "encounter_id", "left"), facts)
    assert sorted(r.encounter_id for r in kept.collect()) == [2, 4, 7, 8]
