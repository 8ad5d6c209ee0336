"""Scalar functions: text, dates, drug regimens."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretrail.checks.care_sql import months, years
from caretrail.checks.registry import check
from caretrail.checks.reports import DuckText
from caretrail.functions import dates as d
from caretrail.functions import regimens as rg
from caretrail.functions import text as tx
from caretrail.sources.tables import Tables, live

c = F.col


@check(
    "j01_split_part",
    "J1 J30",
    "SELECT c_custkey, SPLIT_PART(c_name, '#', 1) AS head, SPLIT_PART(c_name, '#', 2) AS tail, SPLIT_PART(c_name, '#', 3) AS none, LENGTH(c_name) AS n, REPLACE(c_name, '#', '-') AS swapped FROM customer",
)
def split_part(t: Tables) -> DataFrame:
    name = c("c_name")
    return t.raw("customer").select(
        "c_custkey",
        tx.split_part(name, "#", 1).alias("head"),
        tx.split_part(name, "#", 2).alias("tail"),
        tx.split_part(name, "#", 3).alias("none"),
        F.length(name).alias("n"),
        F.replace(name, F.lit("#"), F.lit("-")).alias("swapped"),
    )


@check(
    "j02_title_case",
    "J2",
    """SELECT p_partkey, LIST_REDUCE(LIST_TRANSFORM(REGEXP_EXTRACT_ALL(LOWER(p_name || '.' || p_type || '-' || p_brand), '[a-z0-9#]+|[^a-z0-9#]+'), lambda w: UPPER(w[1]) || w[2:]), lambda a, b: a || b) AS title FROM part""",
)
def title_case(t: Tables) -> DataFrame:
    return t.raw("part").select("p_partkey", tx.title_case(F.concat("p_name", F.lit("."), "p_type", F.lit("-"), "p_brand")).alias("title"))


DRUG_LISTS = """l AS (SELECT person_id, LIST(DISTINCT CAST(value_coded AS VARCHAR) ORDER BY CAST(value_coded AS VARCHAR)) AS codes FROM obs WHERE voided = 0 AND concept_id = 1250 GROUP BY person_id)"""


def _drug_lists(t: Tables) -> DataFrame:
    drugs = live(t.obs).filter("concept_id = 1250")
    return drugs.groupBy("person_id").agg(F.array_sort(F.collect_set(c("value_coded").cast("string"))).alias("codes"))


_parts = ", ".join(f"({i}, '{code}', {[str(x) for x in has]})" for i, (code, _, has) in enumerate(rg.COMPONENTS))
_named = ", ".join(
    f"({i}, '{name}', {[str(x) for x in has if x not in rg.NAME_EXCEPTIONS.get(code, ())]})" for i, (code, name, has) in enumerate(rg.COMPONENTS)
)
_REGIMEN = f"(SELECT STRING_AGG(code, ' ## ' ORDER BY i) FROM (VALUES {_parts}) AS v(i, code, has) WHERE list_has_any(has, codes))"
_NAMES = f"(SELECT STRING_AGG(name, ' ## ' ORDER BY i) FROM (VALUES {_named}) AS v(i, name, has) WHERE list_has_any(has, string_split(regimen, ' ## ')))"


@check(
    "j03_regimen_of_codes",
    "J3 J5 J10 J22 L1 L4",
    f"""WITH {DRUG_LISTS}, r AS (SELECT person_id, {_REGIMEN} AS regimen FROM l)
    SELECT person_id, regimen, {_NAMES} AS names, LENGTH(regimen) - LENGTH(REPLACE(regimen, '##', '#')) + 1 AS n_drugs FROM r""",
)
def regimen(t: Tables) -> DataFrame:
    df = _drug_lists(t).withColumn("regimen", rg.components_of(c("codes")))
    return df.select("person_id", "regimen", rg.drug_names(c("regimen")).alias("names"), F.size(F.split("regimen", " ## ")).alias("n_drugs"))


_combos = ", ".join(f"('{k}', {v})" for k, vs in rg.COMBINATIONS.items() for v in vs)


@check(
    "j04_expand_combinations",
    "J4",
    f"""WITH {DRUG_LISTS}, u AS (SELECT person_id, UNNEST(codes) AS code FROM l),
     e AS (SELECT DISTINCT person_id, COALESCE(v, CAST(u.code AS INTEGER)) AS part FROM u LEFT JOIN (VALUES {_combos}) AS k(code, v) ON k.code = u.code)
    SELECT person_id, STRING_AGG(CAST(part AS VARCHAR), ' ## ' ORDER BY part) AS components FROM e GROUP BY person_id""",
)
def combinations(t: Tables) -> DataFrame:
    return _drug_lists(t).select("person_id", rg.expand_combinations(c("codes")).alias("components"))


_adult = "CASE r " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in rg.ADULT_CODES.items()) + " ELSE 'adult unknown' END"
_child = "CASE r " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in rg.CHILD_CODES.items()) + " ELSE 'peds unknown' END"


@check(
    "j06_national_regimen_code",
    "J6",
    f"""WITH x AS (SELECT o.encounter_id, {years('p.birthdate', "DATE '1985-06-30'")} AS age, LIST(DISTINCT CAST(value_coded AS VARCHAR)) AS codes FROM obs o JOIN person p ON p.person_id = o.person_id
      WHERE o.voided = 0 AND concept_id = 1250 GROUP BY 1, 2), y AS (SELECT encounter_id, age, {_REGIMEN} AS r FROM x)
    SELECT encounter_id, CASE WHEN age >= 12 THEN {_adult} WHEN age < 12 THEN {_child} END AS code FROM y""",
)
def national_code(t: Tables) -> DataFrame:
    obs = live(t.obs).filter("concept_id = 1250").join(t.person.select("person_id", "birthdate"), "person_id")
    df = obs.groupBy("encounter_id", "birthdate").agg(F.collect_set(c("value_coded").cast("string")).alias("codes"))
    age = d.years_between(c("birthdate"), F.lit("1985-06-30").cast("date"))
    return df.select("encounter_id", rg.national_code(rg.components_of(c("codes")), age).alias("code"))


CHEMO_CODES = (7213, 491, 8486, 8480, 8479, 7207, 7203)
_chemo_list = ", ".join(str(x) for x in CHEMO_CODES)
_chemo = ", ".join(f"({i}, '{n}', {[str(x) for x in need]}, {[str(x) for x in out] or ['-']})" for i, (n, need, out) in enumerate(rg.CHEMO))
INFANT = ", ".join(str(x) for x in (*rg.INFANT_PROPHYLAXIS, 80586))


@check(
    "j08_chemotherapy_regimens",
    "J8 J9",
    f"""WITH l AS (SELECT l_orderkey AS encounter_id, LIST(DISTINCT CAST([{_chemo_list}][CAST((l_partkey + l_linenumber) % 7 AS INTEGER) + 1] AS VARCHAR)) AS drugs,
      LIST(DISTINCT CAST([{INFANT}][CAST((l_partkey + l_suppkey) % 5 AS INTEGER) + 1] AS VARCHAR)) AS infant FROM lineitem GROUP BY 1)
    SELECT encounter_id, (SELECT STRING_AGG(n, ' ## ' ORDER BY i) FROM (VALUES {_chemo}) AS v(i, n, need, without) WHERE list_has_all(drugs, need) AND NOT list_has_any(drugs, without)) AS regimens,
      (SELECT STRING_AGG(k, ' ## ' ORDER BY i) FROM (VALUES {', '.join(f"({i}, '{k}')" for i, k in enumerate(rg.INFANT_PROPHYLAXIS))}) AS v(i, k) WHERE list_contains(infant, k)) AS prophylaxis FROM l""",
)
def chemotherapy(t: Tables) -> DataFrame:
    drug = F.get(F.array(*[F.lit(str(x)) for x in CHEMO_CODES]), ((c("l_partkey") + c("l_linenumber")) % 7).cast("int"))
    infant = F.get(F.array(*[F.lit(x.strip()) for x in INFANT.split(",")]), ((c("l_partkey") + c("l_suppkey")) % 5).cast("int"))
    df = t.raw("lineitem").groupBy(c("l_orderkey").alias("encounter_id")).agg(F.collect_set(drug).alias("drugs"), F.collect_set(infant).alias("infant"))
    return df.select("encounter_id", rg.chemo_regimens(c("drugs")).alias("regimens"), rg.infant_prophylaxis(c("infant")).alias("prophylaxis"))


@check(
    "j11_date_differences",
    "J11 J12 J15",
    f"""SELECT encounter_id, {years('birthdate', 'encounter_date')} AS years, {months('birthdate', 'encounter_date')} AS months, CAST(TRUNC((encounter_date - birthdate) / 7.0) AS INTEGER) AS weeks, encounter_date - birthdate AS days,
      CASE WHEN {years('birthdate', 'encounter_date')} > 0 THEN {years('birthdate', 'encounter_date')} ELSE ROUND({months('birthdate', 'encounter_date')} / 12.0, 2) END AS age,
      {months('date_created', 'encounter_date')} AS back FROM encounter JOIN person USING (person_id)""",
)
def date_differences(t: Tables) -> DataFrame:
    df = t.encounter.join(t.person.select("person_id", "birthdate"), "person_id")
    b, e = c("birthdate"), c("encounter_date")
    return df.select(
        "encounter_id",
        d.years_between(b, e).alias("years"),
        d.months_between(b, e).alias("months"),
        d.complete_units("week", b, e).alias("weeks"),
        d.complete_units("day", b, e).alias("days"),
        d.age_at(b, e).alias("age"),
        d.months_between(c("date_created"), e).alias("back"),
    )


@check("j13_yearweek", "J13", f"SELECT encounter_id, {DuckText.yearweek('encounter_date')} AS year_week FROM encounter")
def yearweek(t: Tables) -> DataFrame:
    return t.encounter.select("encounter_id", d.yearweek(c("encounter_date")).alias("year_week"))


@check(
    "j16_time_zone_days",
    "J16",
    "SELECT CAST(obs_datetime + INTERVAL 3 HOUR AS DATE) AS day, COUNT(*) AS n FROM lab_event GROUP BY 1",
)
def time_zone(t: Tables) -> DataFrame:
    local = d.in_zone(c("obs_datetime"))
    return t.lab_event.groupBy(F.to_date(local).alias("day")).agg(F.count(F.lit(1)).alias("n"))


@check(
    "j17_dates_from_parts",
    "J17 J18 J19",
    """SELECT encounter_id, encounter_date AS parsed, encounter_date + 280 AS due, encounter_date + CAST((40 - encounter_id % 45) * 7 AS INTEGER) AS due_by_weeks, CAST(encounter_date - INTERVAL 9 MONTH AS DATE) AS conceived FROM encounter""",
)
def date_parts(t: Tables) -> DataFrame:
    day = c("encounter_date")
    return t.encounter.select(
        "encounter_id",
        d.date_from_parts(F.date_format(day, "yyyy/MM/dd")).alias("parsed"),
        d.due_date_from_period(day).alias("due"),
        d.due_date_from_weeks(day, c("encounter_id") % 45).alias("due_by_weeks"),
        d.conception_from_due(day).alias("conceived"),
    )


@check(
    "j20_body_mass_index",
    "J20 J28",
    "SELECT encounter_id, weight / NULLIF((weight + 80) * (weight + 80), 0) * 10000 AS bmi, ABS(weight - 60) AS off, CEIL(weight / 7) AS up, GREATEST(weight, 50) AS least_50 FROM spine WHERE weight IS NOT NULL",
)
def bmi(t: Tables) -> DataFrame:
    from caretrail.plans.spine import measured

    w, h = c("weight"), c("weight") + 80
    return measured(t).filter("weight IS NOT NULL").select(
        "encounter_id",
        (w / F.nullif(h * h, F.lit(0.0)) * 10000).alias("bmi"),
        F.abs(w - 60).alias("off"),
        F.ceil(w / 7).alias("up"),
        F.greatest(w, F.lit(50.0)).alias("least_50"),
    )


@check(
    "j21_estimated_return_date",
    "J21",
    """SELECT encounter_id, CASE WHEN rtc_date IS NOT NULL THEN rtc_date WHEN n IS NOT NULL THEN encounter_date + CAST(FLOOR(n * CASE encounter_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 7 ELSE 30.25 END) AS INTEGER) END AS return_date,
      CASE WHEN rtc_date IS NULL AND n IS NOT NULL THEN 1 ELSE 0 END AS rtc_estimated FROM (SELECT *, CASE WHEN weight IS NOT NULL THEN CAST(weight AS INTEGER) % 12 + 1 END AS n FROM spine)""",
)
def return_date(t: Tables) -> DataFrame:
    from caretrail.operators.episodes import estimated_return
    from caretrail.plans.spine import measured

    df = measured(t).withColumn("n", c("weight").cast("int") % 12 + 1)
    unit = F.when(c("encounter_id") % 3 == 0, "days").when(c("encounter_id") % 3 == 1, "weeks").otherwise("months")
    date, guessed = estimated_return(c("rtc_date"), c("encounter_date"), c("n"), unit)
    return df.select("encounter_id", date.alias("return_date"), guessed.alias("rtc_estimated"))


@check(
    "j24_filing_and_site_ids",
    "J24 J25 J26 J29",
    """SELECT person_id, identifier, SUBSTRING(identifier, 8, 2) || '-' || SUBSTRING(identifier, 6, 2) || '-' || SUBSTRING(identifier, 4, 2) || '-' || SUBSTRING(identifier, 2, 2) || '-' || SUBSTRING(identifier, 1, 1) AS filing,
      CASE UPPER(SUBSTRING(identifier, 1, 2)) WHEN 'MT' THEN 'teaching hospital' WHEN 'TU' THEN 'town' WHEN 'WB' THEN 'west' WHEN 'MO' THEN 'rural' ELSE 'unknown' END AS site,
      CASE WHEN REGEXP_MATCHES(identifier || ' x', '\\b(x|y)\\b') THEN 1 ELSE 0 END AS whole FROM patient_identifier""",
)
def filing(t: Tables) -> DataFrame:
    sites = {"MT": "teaching hospital", "TU": "town", "WB": "west", "MO": "rural"}
    return t.patient_identifier.select(
        "person_id",
        "identifier",
        tx.filing_id(c("identifier")).alias("filing"),
        tx.site_from_identifier(c("identifier"), sites).alias("site"),
        F.when(tx.whole_word(F.concat("identifier", F.lit(" x")), "x", "y"), 1).otherwise(0).alias("whole"),
    )


@check(
    "l01_functions_in_sql",
    "L1",
    "SELECT encounter_id, MIN(CASE WHEN concept_id = 856 THEN value END) IS NOT NULL AS has_vl, STRING_AGG(CASE WHEN concept_id = 1250 THEN value END, ' ## ' ORDER BY value_coded) AS drugs FROM tall GROUP BY encounter_id",
)
def functions_in_sql(t: Tables) -> DataFrame:
    from caretrail.functions.registered import register
    from caretrail.operators.flatten import flatten

    register(t.spark)
    flat = flatten(live(t.obs), ["encounter_id"])
    return t.spark.sql("SELECT encounter_id, get_values(obs, 856) IS NOT NULL AS has_vl, get_values(obs, 1250) AS drugs FROM {flat}", flat=flat)


@check(
    "l01_regimen_functions_in_sql",
    "L1 J3 J4 J5 J6",
    f"""WITH {DRUG_LISTS}, r AS (SELECT person_id, {_REGIMEN} AS r FROM l), n AS (SELECT person_id, r AS regimen FROM r),
     e AS (SELECT DISTINCT person_id, COALESCE(v, CAST(u.code AS INTEGER)) AS part FROM (SELECT person_id, UNNEST(codes) AS code FROM l) u LEFT JOIN (VALUES {_combos}) AS k(code, v) ON k.code = u.code),
     x AS (SELECT person_id, STRING_AGG(CAST(part AS VARCHAR), ' ## ' ORDER BY part) AS components FROM e GROUP BY person_id)
    SELECT person_id, r AS regimen, {_NAMES.replace('regimen', 'n.regimen')} AS names, components, {_adult} AS adult_code, {_child} AS child_code FROM r JOIN n USING (person_id) JOIN x USING (person_id)""",
)
def regimen_functions_in_sql(t: Tables) -> DataFrame:
    from caretrail.functions.registered import register
    from caretrail.operators.flatten import flatten

    register(t.spark)
    flat = flatten(live(t.obs).filter("concept_id = 1250"), ["person_id"])
    return t.spark.sql(
        """SELECT person_id, regimen, get_arv_names(regimen) AS names, components, get_moh_arv_code(regimen, 30, 1) AS adult_code, get_moh_arv_code(regimen, 3, 1) AS child_code
        FROM (SELECT person_id, normalize_arvs(obs, '1250') AS regimen, get_arv_concept_ids(obs, 1250) AS components FROM {flat})""",
        flat=flat,
    )
