"""Single operators on small frames, with the deliberate differences from the reference behaviour."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from caretrail.functions import dates as d
from caretrail.functions import obs as enc
from caretrail.functions import regimens as rg
from caretrail.functions import text as tx
from caretrail.operators import fold, joins, periods, quality, rules
from caretrail.operators.facts import asked, code, drugs, extract_facts, number, regimen_of_bits, said
from caretrail.operators.flatten import answer_map, flatten, typed_value
from caretrail.operators.forms import form, form_answers

c = F.col
DAY = dt.date


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def day(text):
    return F.lit(text).cast("date")


@pytest.mark.parametrize("text,key", [("2018-12-30", 201852), ("2019-01-01", 201852), ("2019-05-11", 201918), ("2017-01-01", 201701)])
def test_yearweek(spark, text, key):
    assert one(spark, d.yearweek(day(text))) == key


@pytest.mark.parametrize(
    "a,b,months", [("2020-01-31", "2020-02-29", 0), ("2020-01-31", "2020-03-01", 1), ("2020-03-01", "2020-01-31", -1), ("2020-01-15", "2020-02-15", 1)]
)
def test_complete_months(spark, a, b, months):
    assert one(spark, d.months_between(day(a), day(b))) == months


def test_age_below_one_year_is_a_fraction(spark):
    assert one(spark, d.age_at(day("2020-01-15"), day("2020-07-20"))) == 0.5
    assert one(spark, d.age_at(day("2010-01-15"), day("2020-07-20"))) == 10.0


def test_keys_and_codes_match_whole(spark):
    obs = F.lit("!!112=5!! ## !!9082=90360!! ## !!12=7!!")
    assert one(spark, enc.encoded_first(obs, 12)) == "7"
    assert one(spark, enc.encoded_said(obs, [9082], [9036])) is False
    assert one(spark, enc.encoded_joined(obs, 99)) is None
    assert one(spark, enc.encoded_custom(obs, "99")) == ""


def test_lenient_numbers(spark):
    for text, value in (("12abc", 12.0), (" -3.5 kg", -3.5), ("abc", None), ("", None)):
        assert one(spark, enc.lenient_number(F.lit(text))) == value


def test_title_case(spark):
    assert one(spark, tx.title_case(F.lit("o'BRIEN-smith (west) 3rd"))) == "O'Brien-Smith (West) 3rd"


def test_split_part(spark):
    assert [one(spark, tx.split_part(F.lit("a.b.c"), ".", i)) for i in (1, 3, 4)] == ["a", "c", ""]


@pytest.mark.parametrize(
    "codes,regimen,names", [(["6964"], "628 ## 633 ## 802", "3TC ## EFV ## TDF"), (["630", "633"], "628 ## 633 ## 797", "3TC ## EFV ## AZT"), (["1"], None, None)]
)
def test_regimens(spark, codes, regimen, names):
    arr = F.array(*[F.lit(x) for x in codes])
    assert one(spark, rg.components_of(arr)) == regimen
    assert one(spark, rg.drug_names(rg.components_of(arr))) == names


def test_combinations_expand_to_sorted_codes(spark):
    assert one(spark, rg.expand_combinations(F.array(F.lit("794"), F.lit("1400")))) == "628 ## 795 ## 802 ## 9026"


def test_national_codes_by_age(spark):
    text = F.lit("628 ## 633 ## 802")
    assert one(spark, rg.national_code(text, F.lit(30))) == "AF2B"
    assert one(spark, rg.national_code(text, F.lit(3))) == "CF4B"
    assert one(spark, rg.national_code(F.lit("1"), F.lit(30))) == "adult unknown"


def test_status_cuts_and_fallback(spark):
    def at(rtc, seen="2020-01-01", end="2020-02-15"):
        null = F.lit(None).cast("date")
        rtc = null if rtc is None else day(rtc)
        return one(spark, rules.care_status(day(end), day(seen), rtc, null, null, rules.MONTHLY_CUTS, day("2020-02-01")))

    assert at("2020-02-01") == "active" and at("2020-03-01") == "active"
    assert at("2020-01-01") == "defaulter" and at("2019-10-01") == "ltfu"
    assert at(None) == "active"


def test_typed_value_and_flatten(spark):
    rows = [(1, 5096, None, None, DAY(2020, 1, 2)), (1, 1250, 628, None, None), (1, 856, None, 40.0, None), (1, 1250, 6964, None, None), (1, 21, None, 9.5, None)]
    df = spark.createDataFrame(rows, "encounter_id int, concept_id int, value_coded int, value_numeric double, value_datetime date").withColumn("obs_date", day("2020-01-01"))
    assert flatten(df, ["encounter_id"]).first()["obs"] == "!!21=9.5!! ## !!856=40!! ## !!1250=628!! ## !!1250=6964!! ## !!5096=2020-01-02!!"
    tall = df.select("encounter_id", "concept_id", "obs_date", typed_value(df).alias("value"))
    a = enc.Answers()
    r = answer_map(tall, ["encounter_id"]).select(a.joined(1250).alias("j"), a.number(856).alias("n"), a.said(1250, 62).alias("s"), a.first(7).alias("none")).first()
    assert tuple(r) == ("628 ## 6964", 40.0, False, None)


def test_facts(spark):
    rows = [(1, 1255, "1256"), (1, 1250, "6964"), (1, 1250, "628"), (1, 856, "1200 cp"), (2, 1255, "12560")]
    tall = spark.createDataFrame(rows, "encounter_id int, concept_id int, value string").withColumn("obs_date", day("2020-01-01"))
    facts = {"start": said(1255, 1256), "plan": asked(1255), "drug": code(1250), "meds": drugs(1250), "vl": number(856)}
    out = {r["encounter_id"]: r for r in extract_facts(tall, ["encounter_id"], facts).withColumn("meds", regimen_of_bits(c("meds"))).collect()}
    assert (out[1]["start"], out[1]["plan"], out[1]["drug"], out[1]["meds"], out[1]["vl"]) == (1, 1, 628, "628 ## 633 ## 802", 1200.0)
    assert (out[2]["start"], out[2]["plan"], out[2]["meds"]) == (0, 1, None)


def test_form_answer_listed_first_counts(spark):
    spec = form("f", (1,), "a 10 5 6 7\nb 11 yesno\nc 12 text\nd 13 5=0 6=0 7=2")
    rows = [(1, 10, "7"), (1, 10, "6"), (1, 11, "1066"), (1, 12, "x"), (1, 12, "a"), (1, 13, "7"), (1, 10, "65")]
    tall = spark.createDataFrame(rows, "encounter_id int, concept_id int, value string")
    assert tuple(form_answers(tall, spec, ["encounter_id"]).first()) == (1, 2, 0, "a ## x", 2)


def test_guarded_results(spark):
    """Form reports near the known result or older than it are not taken; a laboratory result always is."""
    base = DAY(2020, 1, 1)
    at = lambda n: base + dt.timedelta(days=n)
    rows = [(1, at(0), 100.0, None, None), (1, at(10), None, 200.0, at(10)), (1, at(45), None, 300.0, at(45)), (1, at(50), 400.0, None, None)]
    daily = spark.createDataFrame(rows, "person_id int, day date, lab_value double, form_value double, form_date date")
    out = fold.accepted_results(daily, ["person_id"]).orderBy("day").collect()
    assert [(r["value_1"], r["value_2"]) for r in out] == [(100.0, None), (100.0, None), (300.0, 100.0), (400.0, 300.0)]


def test_period_validity_equals_cross_join(spark):
    rows = [(1, DAY(2020, 1, 15), DAY(2020, 4, 30)), (2, DAY(2020, 1, 31), None), (3, DAY(2020, 2, 1), DAY(2020, 2, 20)), (4, DAY(2019, 1, 1), DAY(2020, 1, 31))]
    df = spark.createDataFrame(rows, "id int, since date, until date")
    for unit in ("month", "week", "day"):
        got = periods.valid_in_period(df, unit, c("since"), c("until"), "2020-01-10", "2020-05-31").select("id", "period_end")
        cal = periods.calendar(spark, unit, "2020-01-10", "2020-05-31").select("period_end")
        want = df.crossJoin(cal).filter("since <= period_end AND (until IS NULL OR until > period_end)").select("id", "period_end")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())), unit


def test_last_day_of_month_counts_as_that_month(spark):
    df = spark.createDataFrame([(1, dt.datetime(2020, 1, 31, 14, 0))], "id int, at timestamp")
    out = periods.as_of(df, "month", "at", ["id"], ["at"], "2020-01-01", "2020-02-29").collect()
    assert sorted(r["period_end"] for r in out) == [DAY(2020, 1, 31), DAY(2020, 2, 29)]


def test_overlay_keeps_nulls_of_the_later_frame(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    b = spark.createDataFrame([(1, None), (3, "c")], "k int, v string")
    assert sorted(map(tuple, joins.overlay([a, b], ["k"]).collect())) == [(1, None), (2, "b"), (3, "c")]


def test_first_after_is_strict(spark):
    rows = spark.createDataFrame([(1, DAY(2020, 1, 1)), (1, DAY(2020, 1, 5))], "p int, at date")
    events = spark.createDataFrame([(1, DAY(2020, 1, 1)), (1, DAY(2020, 1, 5)), (1, DAY(2020, 1, 9))], "p int, on date")
    out = joins.first_after(rows, events, "p", "at", "on", "next").orderBy("at").collect()
    assert [r["next"] for r in out] == [DAY(2020, 1, 5), DAY(2020, 1, 9)]


def test_differences_are_null_safe(spark):
    a = spark.createDataFrame([(1, None), (2, 5), (3, 1)], "k int, v int")
    b = spark.createDataFrame([(1, None), (2, 6), (4, 1)], "k int, v int")
    out = {r["k"]: r["difference"] for r in quality.differences(a, b, ["k"], ["v"]).collect()}
    assert out == {2: "differs", 3: "only in a", 4: "only in b"}
