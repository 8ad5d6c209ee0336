"""Record-shaped views over the driver tables.

The text is plain SQL that Spark and DuckDB both accept. Spark builds the input frames from it, and the
oracles put the same text in front of their own queries, so that both sides start from the same rows.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    "person": """
SELECT c_custkey AS person_id,
 CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
 CAST('1950-01-01' AS DATE) + CAST((c_custkey * 37) % 16000 AS INT) AS birthdate,
 CASE WHEN c_custkey % 29 = 0 THEN CAST('1999-01-01' AS DATE) + CAST(c_custkey % 700 AS INT) END AS death_date,
 CASE WHEN c_custkey % 97 = 0 THEN 1 ELSE 0 END AS voided,
 CASE WHEN c_custkey % 97 = 0 THEN CAST('1999-06-01' AS DATE) + CAST(c_custkey % 800 AS INT) END AS date_voided,
 CASE WHEN c_custkey % 41 = 7 THEN CAST('1999-09-01' AS DATE) + CAST((c_custkey * 13) % 900 AS INT) END AS date_changed,
 CASE WHEN c_custkey % 53 = 0 THEN 1 ELSE 0 END AS is_test,
 c_nationkey AS home_location_id, c_mktsegment AS population_type
FROM customer""",
    "location": """
SELECT n_nationkey AS location_id, n_name AS name, r_name AS county
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "encounter": """
SELECT o_orderkey AS encounter_id, o_custkey AS person_id,
 CAST(o_orderdate AS DATE) AS encounter_date, o_orderdate AS encounter_datetime,
 CASE SUBSTRING(o_orderpriority, 1, 1) WHEN '1' THEN 1 WHEN '2' THEN 2 WHEN '3' THEN 21 WHEN '4' THEN 14 ELSE 116 END AS encounter_type,
 CASE WHEN o_orderkey % 7 = 0 THEN CAST((c_nationkey + 1) % 25 AS INT) ELSE c_nationkey END AS location_id,
 CASE WHEN o_orderstatus = 'P' AND o_orderkey % 10 = 0 THEN 1 ELSE 0 END AS voided,
 CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INT) AS date_created,
 CASE WHEN o_orderkey % 9 = 0 THEN CAST(o_orderdate AS DATE) + CAST(60 + o_orderkey % 500 AS INT) END AS date_changed,
 CASE WHEN o_orderstatus = 'P' AND o_orderkey % 10 = 0 THEN CAST(o_orderdate AS DATE) + CAST(50 + o_orderkey % 300 AS INT) END AS date_voided
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "obs": """
SELECT l_orderkey AS encounter_id, o_custkey AS person_id, CAST(l_shipdate AS DATE) AS obs_date,
 CASE l_linenumber WHEN 1 THEN 856 WHEN 2 THEN 5497 WHEN 3 THEN 5096 WHEN 4 THEN 1250 WHEN 5 THEN 1255 WHEN 6 THEN 5089 ELSE 5085 END AS concept_id,
 CASE l_linenumber WHEN 4 THEN CASE CAST(l_partkey % 5 AS INT) WHEN 0 THEN 6964 WHEN 1 THEN 6467 WHEN 2 THEN 794 WHEN 3 THEN 9759 ELSE 628 END
                   WHEN 5 THEN CASE CAST(l_partkey % 4 AS INT) WHEN 0 THEN 1256 WHEN 1 THEN 1257 WHEN 2 THEN 1260 ELSE 1107 END END AS value_coded,
 CASE l_linenumber WHEN 1 THEN FLOOR(l_extendedprice / 25) WHEN 2 THEN l_quantity * 20 WHEN 6 THEN l_quantity + 40 WHEN 7 THEN l_quantity + 90 END AS value_numeric,
 CASE l_linenumber WHEN 3 THEN CAST(l_shipdate AS DATE) END AS value_datetime,
 CASE WHEN l_returnflag = 'R' AND l_partkey % 10 = 0 THEN 1 ELSE 0 END AS voided,
 CAST(l_shipdate AS DATE) AS date_created,
 CASE WHEN l_partkey % 25 = 3 THEN CAST(l_shipdate AS DATE) + CAST(100 + l_partkey % 1500 AS INT) END AS date_changed,
 CASE WHEN l_returnflag = 'R' AND l_partkey % 10 = 0 THEN CAST(l_shipdate AS DATE) + CAST(200 + l_partkey % 1500 AS INT) END AS date_voided
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "clinical_order": """
SELECT l_orderkey AS encounter_id, o_custkey AS person_id,
 CASE WHEN l_linenumber = 1 THEN 856 WHEN l_linenumber = 2 THEN 657 ELSE 1030 END AS concept_id, CAST(o_orderdate AS DATE) AS date_activated,
 CASE WHEN l_partkey % 31 = 4 THEN CAST(o_orderdate AS DATE) + CAST(90 + l_partkey % 700 AS INT) END AS date_changed
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' AND l_linenumber <= 3""",
    "lab_event": """
SELECT event_id AS obs_id, user_id AS person_id, ts AS obs_datetime,
 CASE event_type WHEN 'purchase' THEN 856 WHEN 'view' THEN 5497 WHEN 'click' THEN 730 WHEN 'signup' THEN 1030 ELSE 9239 END AS concept_id,
 value AS value_numeric,
 CAST(ts AS DATE) + CAST(event_id % 20 AS INT) AS date_created,
 CASE WHEN event_id % 23 = 5 THEN CAST(ts AS DATE) + CAST(20 + event_id % 19 AS INT) END AS date_changed
FROM events""",
    "visit": """
SELECT o_orderkey AS visit_id, o_custkey AS person_id, CAST(o_orderdate AS DATE) AS date_started,
 CASE CAST(o_orderkey % 11 AS INT) WHEN 0 THEN 24 WHEN 1 THEN 23 WHEN 2 THEN 119 WHEN 3 THEN 25 WHEN 4 THEN 2 ELSE 3 END AS visit_type_id
FROM orders WHERE o_orderstatus <> 'P'""",
    "patient_program": """
SELECT o_orderkey AS patient_program_id, o_custkey AS person_id, CAST(1 + o_orderkey % 4 AS INT) AS program_id,
 CAST(o_orderdate AS DATE) AS date_enrolled,
 CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) + CAST(60 + o_orderkey % 400 AS INT) END AS date_completed,
 CAST(o_orderkey % 25 AS INT) AS location_id
FROM orders""",
    "relationship": """
SELECT m.c_custkey AS person_a, c.c_custkey AS person_b, 2 AS relationship
FROM customer c JOIN customer m ON m.c_custkey = c.c_custkey - c.c_custkey % 3 + 2 WHERE c.c_custkey <> m.c_custkey""",
    "person_name": """
SELECT c_custkey AS person_id, CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE SUBSTRING(c_name, 1, 8) END AS given_name,
 CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS middle_name, SUBSTRING(c_name, 10, 9) AS family_name
FROM customer""",
    "patient_identifier": """
SELECT o_custkey AS person_id, CAST(1 + o_orderkey % 8 AS INT) AS identifier_type,
 CASE CAST(o_orderkey % 5 AS INT) WHEN 0 THEN 'MT' WHEN 1 THEN 'TU' WHEN 2 THEN 'WB' WHEN 3 THEN 'MO' ELSE 'ZZ' END || CAST(1000000000 + o_orderkey AS VARCHAR(20)) AS identifier,
 CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS preferred
FROM orders""",
    "person_address": """
SELECT c_custkey AS person_id, n_name AS address1 FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "person_attribute": """
SELECT c_custkey AS person_id, 10 AS attribute_type_id, '0700' || CAST(100000 + c_custkey AS VARCHAR(20)) AS value FROM customer WHERE c_acctbal > 0
UNION ALL SELECT c_custkey, 68, CAST(c_custkey % 40 AS VARCHAR(20)) FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT c_custkey, 28, CASE WHEN c_custkey % 53 = 0 THEN 'true' ELSE 'false' END FROM customer""",
    "encounter_provider": """
SELECT l_orderkey AS encounter_id, l_suppkey AS provider_id, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS voided
FROM lineitem WHERE l_linenumber = 1""",
}

# The driver tables each view is built on.
BASE = {
    "person": ["customer"],
    "location": ["nation", "region"],
    "encounter": ["orders", "customer"],
    "obs": ["lineitem", "orders"],
    "clinical_order": ["lineitem", "orders"],
    "lab_event": ["events"],
    "visit": ["orders"],
    "patient_program": ["orders"],
    "relationship": ["customer"],
    "person_name": ["customer"],
    "patient_identifier": ["orders"],
    "person_address": ["customer", "nation"],
    "person_attribute": ["customer"],
    "encounter_provider": ["lineitem"],
}


def answer_rows_sql(questions: list[tuple[int, str, int]]) -> str:
    """Tall observations that answer a questionnaire, one per line item.

    A question is (concept, kind, code) with kind 'coded', 'number' or 'date'. Every line item answers the
    question picked by its part and supplier, so each question of a form is answered about equally often.
    """
    rows = ", ".join(f"({i}, {c}, '{k}', {v})" for i, (c, k, v) in enumerate(questions))
    return f"""
SELECT l.l_orderkey AS encounter_id, o.o_custkey AS person_id, CAST(l.l_shipdate AS DATE) AS obs_date, q.concept_id AS concept_id,
 CASE q.kind WHEN 'coded' THEN CAST(q.code AS VARCHAR(20))
             WHEN 'number' THEN CAST(CAST(l.l_quantity * q.code AS INT) AS VARCHAR(20))
             ELSE CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR(20)) END AS value
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN (SELECT * FROM (VALUES {rows}) AS v(slot, concept_id, kind, code)) q
 ON (l.l_partkey * 7 + l.l_suppkey * 3 + l.l_linenumber) % {len(questions)} = q.slot"""


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """Put the views that a query names in front of it as common table expressions."""
    texts = {**VIEWS, **(extra or {})}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in texts:
            if re.search(rf"\b(?:FROM|JOIN|,)\s+{name}\b", text, re.I) and name not in needed:
                if name not in VIEWS and texts[name] is not text:
                    visit(texts[name])
                if name not in needed and texts[name] is not text:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    ctes = ",\n".join(f"{n} AS ({texts[n]})" for n in needed)
    body = sql.strip()
    if body[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body[:5].upper() == "WITH ":
        return f"WITH RECURSIVE {ctes},\n{body[5:]}"
    return f"WITH RECURSIVE {ctes}\n{body}"
