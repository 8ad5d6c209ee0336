"""Form datasets: what is known from visit to visit, against values written by hand, and hot persons."""

import datetime as dt

from pyspark.sql import functions as F

from caretrail.operators.timeline import ORDER, Timeline
from caretrail.plans import form_datasets as fd
from caretrail.sources.tables import Tables
from caretrail.specs.forms import FORMS
from tests.conftest import SMALL


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def test_history_of_drugs_and_return_dates(spark):
    # visit, day, type, return date, plan, drugs, cancer type asked, code 6042
    visits = [
        (1, 0, 21, None, None, None, None, None),
        (2, 10, 1, day(40), "1257", "7202", "10129", None),
        (3, 20, 1, None, None, None, None, 6555),
        (4, 50, 1, None, "1260", "8506", None, None),
        (5, 60, 1, day(90), "1257 ## 1256", None, None, None),
        (6, 70, 1, None, "1257", "7210", None, None),
    ]
    schema = "encounter_id int, day int, encounter_type int, return_on date, chemotherapy_plan string, medication_history string, cancer_type_asked string, cancer_type_diagnosed int"
    rows = spark.createDataFrame(visits, schema)
    rows = rows.withColumn("encounter_date", F.date_add(F.lit(day(0)), F.col("day"))).withColumn("encounter_datetime", F.col("encounter_date").cast("timestamp_ntz"))
    empty = [F.lit(None).cast("string").alias(n) for n in (*fd.SUBTYPES, "diagnosis", "overall_cancer_stage_group")]
    rows = rows.select("*", F.lit(7).alias("person_id"), F.lit(10).alias("day_rank"), *empty)
    got = {r.encounter_id: r for r in fd.history_columns(rows, Timeline(("person_id",), ORDER)).collect()}
    assert [got[i].enrollment_date for i in range(1, 7)] == [None] + [day(10)] * 5
    assert [got[i].rtc_date for i in range(1, 7)] == [None, day(40), day(40), None, day(90), day(90)]
    assert [got[i].prev_rtc_date for i in range(1, 7)] == [None, None, day(40), day(40), day(40), day(90)]
    assert [got[i].cur_onc_meds for i in range(1, 7)] == [None, "7202", "7202", None, None, "7210"]
    assert [got[i].cur_onc_meds_start_date for i in range(1, 7)] == [None, day(10), day(10), None, day(60), day(60)]
    assert [got[i].cancer_type for i in range(1, 7)] == [None, "10129", "6555", None, None, None]
    assert [got[i].known_cancer_type for i in range(1, 7)] == [None, "10129", "6555", "6555", "6555", "6555"]


def test_every_answer_of_every_question_is_given():
    for spec in FORMS.values():
        given = {(k, a) for k, _, a in fd.questions_of(spec)}
        assert given >= {(q.concept, a) for q in spec.questions for a, _ in q.answers}


def test_hot_persons_give_the_same_rows(spark):
    class Skewed(Tables):
        hot_persons = [4, 10, 17, 33, 50]

    def rows(t):
        return sorted(str(r) for r in fd.history_rows(t, FORMS["M49"], fd.STAND_IN_TYPES).collect())

    assert rows(Skewed(spark, SMALL)) == rows(Tables(spark, SMALL))
