"""The learning tables, derived from the star-schema test tables.

The test folders hold no learning data, so every domain table is a query over them.
The text runs unchanged in Spark and in the SQL check, and every table covers the
whole of its source: all customers are users, all parts lessons, all orders
enrolments and all line items activities. Mapping tables (centre, batch, trade and
career path to subject) come from equality joins on the two-part subject number.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from coursetrail.session import durable_dir

BASE_TABLES = ("region", "nation", "customer", "part", "orders", "lineitem", "events")

VIEWS: dict[str, str] = {
    "people": """
SELECT c_custkey AS id, c_name AS name, c_nationkey AS centre_id, c_acctbal AS balance, c_mktsegment AS segment,
  CASE WHEN c_custkey % 50 = 0 THEN 1 WHEN c_custkey % 50 IN (1, 2) THEN 2
       WHEN c_custkey % 5 = 4 THEN 4 ELSE 3 END AS type,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_custkey % 20 END AS batch_id,
  CASE WHEN c_custkey % 6 = 1 THEN NULL ELSE c_mktsegment END AS trade_id
FROM customer""",
    "users": """
SELECT id, name, concat('u', CAST(id AS string), '@example.org') AS email, CAST(9000000 + id AS string) AS mobile, type,
  CASE WHEN id % 50 = 2 THEN 1 WHEN id % 100 = 1 THEN 0 END AS is_master_trainer,
  centre_id, centre_id % 7 AS project_id, centre_id % 5 AS organisation_id,
  CASE WHEN id % 3 = 0 THEN 1 WHEN id % 7 = 0 THEN NULL ELSE 0 END AS is_ple,
  CASE WHEN balance >= -900 THEN 1 ELSE 0 END AS status,
  TIMESTAMP '2020-01-01 08:30:00' AS created_at,
  CASE WHEN id % 97 = 0 THEN TIMESTAMP '2000-01-01 00:00:00' END AS deleted_at
FROM people""",
    "student_details": """
SELECT id AS user_id, batch_id, trade_id, id % 9 AS educational_qualification_id, id % 4 AS placement_status_id,
  CAST(2018 + id % 6 AS string) AS active_year, CAST(2017 + id % 6 AS string) AS year_of_admission
FROM people WHERE type IN (3, 4)
UNION ALL
SELECT id, CASE WHEN balance > 9800 THEN (id + 7) % 20 END, CASE WHEN balance > 9800 THEN segment END,
  id % 9, id % 4, '2024', '2023'
FROM people WHERE balance > 9600""",
    "trades": """
SELECT DISTINCT c_mktsegment AS id, CASE c_mktsegment WHEN 'MACHINERY' THEN 1 WHEN 'AUTOMOBILE' THEN 1
  WHEN 'BUILDING' THEN 2 WHEN 'HOUSEHOLD' THEN 2 END AS duration FROM customer""",
    "subjects": """
SELECT id, concat('Subject ', CAST(n AS string)) AS name, n, CAST(floor((n - 1) / 5.0) AS int) AS series, n % 5 AS level,
  CASE WHEN n = 22 THEN NULL ELSE n % 3 END AS is_ple, CASE WHEN n % 4 = 3 THEN NULL ELSE n % 4 END AS year_to_map,
  n % 6 AS ple_career_path_id, CASE WHEN n = 23 THEN 0 ELSE 1 END AS status,
  CASE WHEN n = 24 THEN TIMESTAMP '2000-01-01 00:00:00' END AS deleted_at
FROM (SELECT DISTINCT p_brand AS id, CAST(substr(p_brand, 7) AS int) AS n FROM part) b""",
    "lessons": """
SELECT p_partkey AS id, replace(p_name, 'widget', 'Assessment') AS name, p_brand AS subject_id, p_size AS lesson_order,
  p_type AS lesson_type_id, CASE WHEN p_partkey % 23 = 0 THEN 2 ELSE 1 END AS lesson_category_id,
  CASE WHEN p_size % 10 = 0 THEN 1 ELSE 0 END AS is_assessment,
  CASE WHEN p_partkey % 11 <> 0 THEN 1 ELSE 0 END AS student_access,
  CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END AS facilitator_access,
  CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 0 END AS mastertrainer_access,
  CASE WHEN p_partkey % 19 = 0 THEN 0 ELSE 1 END AS status,
  CASE WHEN p_partkey % 29 = 0 THEN TIMESTAMP '2000-01-01 00:00:00' END AS deleted_at
FROM part""",
    "lesson_types": """
SELECT DISTINCT p_type AS id, CASE p_type WHEN 'PROMO' THEN ' PDF ' WHEN 'SMALL' THEN 'mp4' WHEN 'MEDIUM' THEN 'pdf web'
  WHEN 'LARGE' THEN NULL ELSE lower(p_type) END AS name FROM part""",
    "centre_subject": """
SELECT n_nationkey * 1000 + n AS id, n_nationkey AS centre_id, s.id AS subject_id, (n_nationkey + n) % 9 AS subject_order
FROM nation JOIN subjects s ON s.series = n_regionkey
UNION ALL
SELECT n_nationkey * 1000 + 100 + n, n_nationkey, s.id, (n_nationkey + n) % 7
FROM nation JOIN subjects s ON s.level = CAST(floor(n_nationkey / 5.0) AS int)
UNION ALL
SELECT n_nationkey * 1000 + 200 + n, n_nationkey, s.id, (n_nationkey + n) % 5
FROM nation JOIN subjects s ON s.series = (n_regionkey + 2) % 5""",
    "batches": "SELECT DISTINCT batch_id AS id FROM people WHERE batch_id IS NOT NULL",
    "batch_subject": """
SELECT b.id * 1000 + n AS id, b.id AS batch_id, s.id AS subject_id
FROM batches b JOIN subjects s ON s.level = b.id % 5
UNION ALL
SELECT b.id * 1000 + 100 + n, b.id, s.id FROM batches b JOIN subjects s ON s.level = (b.id + 2) % 5
UNION ALL
SELECT b.id * 1000 + 200 + n, b.id, s.id FROM batches b JOIN subjects s ON s.series = CAST(floor(b.id / 4.0) AS int)""",
    "subject_trade": """
SELECT length(t.id) * 1000 + n AS id, t.id AS trade_id, s.id AS subject_id
FROM trades t JOIN subjects s ON s.series = length(t.id) % 5
UNION ALL
SELECT length(t.id) * 1000 + 100 + n, t.id, s.id FROM trades t JOIN subjects s ON s.series = (length(t.id) + 1) % 5
UNION ALL
SELECT length(t.id) * 1000 + 200 + n, t.id, s.id FROM trades t JOIN subjects s ON s.level = length(t.id) % 5
UNION ALL
SELECT length(t.id) * 1000 + 300 + n, t.id, s.id FROM trades t JOIN subjects s ON s.level = (length(t.id) + 1) % 5""",
    "ple_career_paths": """
SELECT k AS id, concat('Path ', CAST(k AS string)) AS name, CASE WHEN k = 5 THEN TIMESTAMP '2000-01-01 00:00:00' END AS deleted_at
FROM (SELECT DISTINCT n_nationkey % 6 AS k FROM nation) p""",
    "subject_ple_career_path": """
SELECT p.id * 1000 + n AS id, p.id AS ple_career_path_id, s.id AS subject_id
FROM ple_career_paths p JOIN subjects s ON s.level = p.id % 5
UNION ALL
SELECT p.id * 1000 + 100 + n, p.id, s.id FROM ple_career_paths p JOIN subjects s ON s.level = (p.id + 3) % 5
UNION ALL
SELECT p.id * 1000 + 200 + n, p.id, s.id FROM ple_career_paths p JOIN subjects s ON s.series = p.id % 5""",
    "ple_career_path_user": """
SELECT o_orderkey AS id, o_custkey AS user_id, o_orderkey % 6 AS job_type_id, o_orderdate AS updated_at,
  CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS status,
  CASE WHEN o_orderkey % 31 = 0 THEN o_orderdate END AS deleted_at
FROM orders""",
    "activities_all": """
SELECT o_custkey AS user_id, l_partkey AS lesson_id,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE round(l_discount * 1000) END AS score,
  CAST(1 + l_linenumber % 5 AS double) AS rating, CAST(l_quantity * 60 AS bigint) AS duration,
  CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS completed, l_shipdate AS completed_at,
  o_orderpriority AS priority, l_linenumber AS line
FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    # Every activity is in one of the two logs, lines 5 and 6 of some orders are in both.
    "learning_activities": """
SELECT user_id, lesson_id, score, rating, duration, completed, completed_at
FROM activities_all WHERE priority <> '1-URGENT' OR line = 6""",
    "facilitator_learning_activities": """
SELECT user_id, lesson_id, CASE WHEN line = 5 THEN score + 10 ELSE score - 10 END AS score, rating, duration, completed, completed_at
FROM activities_all WHERE priority = '1-URGENT' OR line = 5""",
    "login_logs": "SELECT user_id, ts AS created_at FROM events",
    "main_users": """
SELECT id, name, CASE WHEN id % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  TIMESTAMP '2020-01-01 08:30:00' AS created_at, n_name AS centre_name, r_name AS organisation_name, r_name AS centre_state,
  n_name AS centre_district, segment AS trade,
  CASE WHEN batch_id IS NULL THEN NULL ELSE concat('Batch ', CAST(batch_id AS string)) END AS batch_name,
  'Centre' AS centre_type, CASE WHEN type = 1 THEN 'Admin' WHEN type = 2 THEN 'Facilitator' ELSE 'Learner' END AS user_type,
  'web' AS created_platform, CASE WHEN id % 3 = 0 THEN '1' ELSE '0' END AS is_ple, centre_id, batch_id
FROM people JOIN nation ON n_nationkey = centre_id JOIN region ON r_regionkey = n_regionkey""",
    "main_centre_project": """
SELECT n_nationkey AS centre_id, n_nationkey * 3 AS project_id, concat('Program ', CAST(n_nationkey % 4 AS string)) AS program_name,
  concat('Project ', CAST(n_nationkey * 3 AS string)) AS project_name, n_nationkey % 2 AS ple_enabled
FROM nation WHERE n_regionkey <> 0
UNION ALL
SELECT n_nationkey, n_nationkey * 3 + 1, concat('Program ', CAST(n_nationkey % 4 AS string)),
  concat('Project ', CAST(n_nationkey * 3 + 1 AS string)), (n_nationkey + 1) % 2
FROM nation WHERE n_regionkey >= 2
UNION ALL
SELECT n_nationkey, n_nationkey * 3 + 2, NULL, concat('Project ', CAST(n_nationkey * 3 + 2 AS string)), n_nationkey % 2
FROM nation WHERE n_regionkey >= 3""",
    "main_phases": """
SELECT u.id AS p_user_id, u.batch_id AS p_batch_id, u.centre_id AS p_centre_id, cp.project_id AS p_project_id,
  cp.project_id * 10 + u.id % 4 AS p_phase_id, concat('Phase ', CAST(u.id % 4 AS string)) AS phase_name
FROM main_users u JOIN main_centre_project cp ON cp.centre_id = u.centre_id
WHERE cp.ple_enabled = 1 OR u.trade = 'BUILDING'""",
}


def with_clause(body: str, definitions: dict[str, str]) -> str:
    """``WITH`` prefix holding the definitions that ``body`` needs, in their given order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"[a-z_0-9]+", text)):
            if word in definitions and word not in needed:
                needed.add(word)
                visit(definitions[word])

    visit(body)
    parts = [f"{name} AS ({definitions[name].strip()})" for name in definitions if name in needed]
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""


# Small tables are written once per session and folder, so that later plans read them
# with their true size. Their rows are bounded by nations, brands, segments and batches.
STORED = ("trades", "subjects", "lesson_types", "batches", "centre_subject", "batch_subject", "subject_trade",
          "ple_career_paths", "subject_ple_career_path", "main_centre_project")
_stored: dict[tuple[str, str, str], str] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in STORED:
        return _derive(spark, sf_dir, name)
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        path = durable_dir(spark, f"learning-{name}")
        _derive(spark, sf_dir, name).coalesce(1).write.parquet(path)
        _stored[key] = path
    return spark.read.parquet(_stored[key])


def _derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    body = f"SELECT * FROM {name}"
    sources = {base: f"SELECT * FROM parquet.`{sf_dir}/{base}.parquet`" for base in BASE_TABLES}
    definitions = {**sources, **VIEWS}
    words = set(re.findall(r"[a-z_0-9]+", with_clause(body, definitions)))
    for small in STORED:
        if small in words and small != name:
            load(spark, sf_dir, small)
            definitions[small] = f"SELECT * FROM parquet.`{_stored[spark.sparkContext.applicationId, sf_dir, small]}`"
    return spark.sql(with_clause(body, definitions) + body)
