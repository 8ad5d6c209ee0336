"""Registered queries: a Spark job over the given tables, and where SQL can say it the same result in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from caretrail.sources.tables import Tables
from caretrail.sources.views import with_views


@dataclass(frozen=True)
class Check:
    name: str
    ids: str
    run: Callable[[Tables], DataFrame]
    sql: str | None


CHECKS: dict[str, Check] = {}

# Shared pieces of oracle SQL, usable by name like the views.
SHARED: dict[str, str] = {}
SHARED["spine"] = """
SELECT e.encounter_id, e.person_id, e.encounter_date, e.encounter_type, e.location_id,
 CASE e.encounter_type WHEN 116 THEN 20 WHEN 21 THEN 1 ELSE 10 END AS day_rank,
 CASE WHEN e.encounter_type IN (1, 2, 14) THEN 1 ELSE 0 END AS is_clinical,
 o.rtc_date, o.vl, o.vl_date, o.cd4, o.weight, o.drug, o.plan
FROM encounter e JOIN person p ON p.person_id = e.person_id AND p.voided = 0 AND p.is_test = 0
LEFT JOIN (SELECT encounter_id, MIN(CASE WHEN concept_id = 5096 THEN value_datetime END) AS rtc_date,
   MIN(CASE WHEN concept_id = 856 THEN value_numeric END) AS vl, MIN(CASE WHEN concept_id = 856 THEN obs_date END) AS vl_date,
   MIN(CASE WHEN concept_id = 5497 THEN value_numeric END) AS cd4, MIN(CASE WHEN concept_id = 5089 THEN value_numeric END) AS weight,
   MIN(CASE WHEN concept_id = 1250 THEN value_coded END) AS drug, MIN(CASE WHEN concept_id = 1255 THEN value_coded END) AS plan
  FROM obs WHERE voided = 0 GROUP BY encounter_id) o ON o.encounter_id = e.encounter_id
WHERE e.voided = 0"""
SHARED["tall"] = """
SELECT encounter_id, person_id, obs_date, concept_id, value_coded,
 CASE WHEN value_coded IS NOT NULL THEN CAST(value_coded AS VARCHAR)
      WHEN value_numeric = FLOOR(value_numeric) THEN CAST(CAST(value_numeric AS BIGINT) AS VARCHAR)
      WHEN value_numeric IS NOT NULL THEN CAST(value_numeric AS VARCHAR)
      WHEN value_datetime IS NOT NULL THEN CAST(value_datetime AS VARCHAR) END AS value
FROM obs WHERE voided = 0"""


def check(name: str, ids: str, sql: str | None = None, views: dict[str, str] | None = None):
    def register(run: Callable[[Tables], DataFrame]):
        if name in CHECKS:
            raise ValueError(f"query {name} registered twice")
        text = with_views(sql, {**SHARED, **(views or {})}) if sql else None
        CHECKS[name] = Check(name, ids, run, text)
        return run

    return register
