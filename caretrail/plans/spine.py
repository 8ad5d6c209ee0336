"""The timeline spine: live encounters of live, real patients, ranked within the day, with their answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretrail.operators import rules
from caretrail.operators.flatten import answer_map, typed_value
from caretrail.operators.joins import without_test_patients
from caretrail.operators.newest import last_rows
from caretrail.sources.tables import Tables, live


def encounters(t: Tables, keys: DataFrame | None = None) -> DataFrame:
    """Live encounters with rank and clinical flag; `keys` restricts to some persons before anything is shuffled."""
    enc = live(t.encounter)
    if keys is not None:
        enc = enc.join(keys.select("person_id"), "person_id", "left_semi")
    enc = without_test_patients(enc, t.person)
    return enc.select(
        "encounter_id",
        "person_id",
        "encounter_date",
        "encounter_datetime",
        "encounter_type",
        "location_id",
        rules.day_rank(F.col("encounter_type")).alias("day_rank"),
        rules.is_clinical(F.col("encounter_type")).alias("is_clinical"),
    )


def tall_values(t: Tables) -> DataFrame:
    """Live observations with their one value as text."""
    obs = live(t.obs)
    return obs.select("encounter_id", "obs_date", "concept_id", typed_value(obs).alias("value"))


def measured(t: Tables, keys: DataFrame | None = None) -> DataFrame:
    """Spine with the few measurements most reports read, one typed column each."""
    obs = live(t.obs)
    key = ["encounter_id"]
    wide = obs.filter(F.col("concept_id").isin(856, 5096, 5089, 5085, 1250, 1255, 5497)).groupBy(*key).agg(
        F.min(F.when(F.col("concept_id") == 5096, F.col("value_datetime"))).alias("rtc_date"),
        F.min(F.when(F.col("concept_id") == 856, F.col("value_numeric"))).alias("vl"),
        F.min(F.when(F.col("concept_id") == 856, F.col("obs_date"))).alias("vl_date"),
        F.min(F.when(F.col("concept_id") == 5497, F.col("value_numeric"))).alias("cd4"),
        F.min(F.when(F.col("concept_id") == 5089, F.col("value_numeric"))).alias("weight"),
        F.min(F.when(F.col("concept_id") == 1250, F.col("value_coded"))).alias("drug"),
        F.min(F.when(F.col("concept_id") == 1255, F.col("value_coded"))).alias("plan"),
    )
    return encounters(t, keys).join(wide, "encounter_id", "left")


def answered(t: Tables, questions: list[tuple[int, str, int]], types: tuple[int, ...] | None = None) -> DataFrame:
    """Spine with the answers of a questionnaire as a map per encounter."""
    concepts = sorted({q[0] for q in questions})
    answers = answer_map(t.answers(questions), ["encounter_id"], concepts)
    enc = encounters(t)
    if types is not None:
        enc = enc.filter(F.col("encounter_type").isin(*types))
    return enc.join(answers, "encounter_id", "left")



def last_visits(rows: DataFrame, visits: DataFrame) -> DataFrame:
    """The rows of each person's last visit: chosen by date, rank and id among the visits, before anything else of a row is read."""
    order = ["encounter_date", "day_rank", "encounter_id"]
    narrow = visits.select("person_id", "encounter_date", F.col("day_rank").cast("tinyint").alias("day_rank"), "encounter_id")
    return last_rows(rows, narrow, ["person_id"], order, "encounter_id")
