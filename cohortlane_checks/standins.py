"""Role views over the shared test tables.

The SQL runs unchanged in Spark and DuckDB, so a check can inline the same view.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

ROLE_VIEWS = {
    "subscriptions": """
        SELECT n_nationkey AS id, n_name AS name, CASE WHEN n_regionkey <= 1 THEN 'Coach+App' WHEN n_regionkey
        <= 3 THEN 'GLP' ELSE 'Other' END AS type
        FROM nation
    """,
    "consultants": """
        SELECT s_suppkey AS id, s_name AS name
        FROM supplier
    """,
    "patients": """
        SELECT c_custkey AS id, CASE WHEN c_custkey % 17 = 0 THEN '  ' WHEN c_custkey % 23 = 0 THEN CAST(NULL AS
        STRING) ELSE concat(' ', c_name, ' ') END AS firstname, CASE WHEN c_custkey % 3 = 0 THEN '' WHEN
        c_custkey % 3 = 1 THEN CAST(NULL AS STRING) ELSE 'Mid' END AS middlename, c_mktsegment AS lastname, CASE
        c_custkey % 6 WHEN 0 THEN concat('90000', lpad(CAST(c_custkey AS STRING), 5, '0')) WHEN 1 THEN
        concat('+9190000', lpad(CAST(c_custkey AS STRING), 5, '0')) WHEN 2 THEN concat('+91 90000-',
        lpad(CAST(c_custkey AS STRING), 5, '0')) WHEN 3 THEN concat('9190000', lpad(CAST(c_custkey AS STRING),
        5, '0')) WHEN 4 THEN CAST(c_custkey AS STRING) ELSE CAST(NULL AS STRING) END AS phone, CASE c_custkey %
        4 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN 'null' WHEN 2 THEN ' ' ELSE concat('user', CAST(c_custkey
        AS STRING), '@example.test') END AS email, CAST(TIMESTAMP '2024-01-28 00:00:00' + INTERVAL '1' MINUTE *
        CAST(c_custkey * 37 % 5760 AS INT) AS TIMESTAMP) AS created_at, c_acctbal > 0 AS is_active, CASE WHEN
        c_custkey % 10 = 9 THEN 'EXPIRED' ELSE 'ACTIVE_SUBSCRIPTION' END AS status, c_nationkey AS
        active_subscription_id, CAST(c_custkey % 10 AS BIGINT) AS nutritionist_id, CASE WHEN c_custkey % 13 = 0
        THEN CAST(NULL AS DOUBLE) ELSE CAST(70 + c_custkey % 50 AS DOUBLE) END AS start_weight, CAST(68 +
        c_custkey % 41 AS DOUBLE) AS goal_weight, CAST(30 * (c_custkey % 5) AS INT) AS target_duration,
        CAST(DATE '2024-01-01' + INTERVAL '1' DAY * CAST(c_custkey % 31 AS INT) AS DATE) AS
        subscription_start_date, CAST(DATE '2024-01-25' + INTERVAL '1' DAY * CAST(c_custkey % 40 AS INT) AS
        DATE) AS subscription_end_date
        FROM customer
    """,
    "patientfoodlogs": """
        SELECT user_id AS patient_id, CASE WHEN user_id % 7 = 0 THEN CAST(NULL AS TIMESTAMP) ELSE ts END AS date
        FROM events
        WHERE event_type IN ('view', 'click')
    """,
    "patienthabitlogs": """
        SELECT user_id AS patient_id, ts AS date
        FROM events
        WHERE event_type IN ('click', 'signup')
    """,
    "activity": """
        SELECT user_id AS patient_id, ts AS date
        FROM events
        WHERE event_type IN ('purchase', 'view')
    """,
    "metrics": """
        SELECT user_id AS patient_id, event_id, CASE WHEN user_id % 11 = 0 THEN 'STEPS' WHEN event_id % 4 = 0
        THEN 'BODY_FAT' ELSE 'BODY_WEIGHT' END AS name, 60 + value / 10 AS value, CASE WHEN event_id % 97 = 0
        THEN CAST(NULL AS TIMESTAMP) ELSE ts END AS date, ts AS created_at
        FROM events
        WHERE event_type IN ('purchase', 'error')
    """,
    "patientnotes": """
        SELECT o_orderkey AS id, o_custkey AS patient_id, CASE WHEN o_orderkey % 4 = 0 THEN CAST(NULL AS BIGINT)
        ELSE CAST(o_custkey % 10 AS BIGINT) END AS consultant_id, CAST(o_orderdate + INTERVAL '8217' DAY AS
        TIMESTAMP) AS date, o_orderpriority AS description
        FROM orders
        WHERE o_orderstatus <> 'F'
    """,
    "appointment": """
        SELECT o_custkey AS patient_id, CAST(o_orderdate + INTERVAL '8217' DAY AS TIMESTAMP) AS date, CASE WHEN
        o_orderkey % 3 = 0 THEN 'CANCELLED' ELSE 'COMPLETED' END AS status
        FROM orders
        WHERE o_orderstatus = 'F'
    """,
    "chats": """
        SELECT DISTINCT conv_id AS id, conv_id AS patient_id, conv_id % 10 AS consultant_id
        FROM conversations
    """,
    "messages": """
        SELECT conv_id AS chat_id, CASE WHEN role = 'assistant' THEN conv_id % 10 ELSE -1 END AS sender,
        CAST(TIMESTAMP '2024-01-31 12:00:00' - INTERVAL '1' DAY * CAST((conv_id * 3 + turn) % 12 AS INT) AS
        TIMESTAMP) AS messaged_at
        FROM conversations
    """,
    "patientsideeffects": """
        SELECT user_id AS patient_id, CASE event_id % 6 WHEN 0 THEN 'Good' WHEN 1 THEN 'okay' WHEN 2 THEN
        'great' WHEN 3 THEN 'Nausea' WHEN 4 THEN 'Fatigue' ELSE 'Headache' END AS type, CASE WHEN event_id % 5 =
        0 THEN 'COACH' ELSE 'PATIENT' END AS creator, ts AS date
        FROM events
        WHERE event_type = 'signup'
    """,
    "assistant": """
        SELECT event_id AS id, user_id, props AS message, ts AS created_at
        FROM events
        WHERE event_type = 'signup'
    """,
    "sheet": """
        SELECT c_custkey AS row_no, CASE WHEN c_custkey % 19 = 0 OR c_custkey % 3 = 1 THEN '' WHEN c_custkey % 2 = 0 THEN
        upper(c_name) ELSE concat('  ', c_name) END AS name, CASE WHEN c_custkey % 3 = 0 THEN 'No scale yet'
        ELSE '' END AS not_onboarding_reason, CASE c_custkey % 6 WHEN 0 THEN '2024-01-05' WHEN 1 THEN
        '06-01-2024' WHEN 2 THEN '7/1/2024' WHEN 3 THEN '8 Jan 2024' WHEN 4 THEN '' ELSE 'n/a' END AS
        glp_1st_dose, CASE WHEN c_custkey % 4 = 0 THEN 'Travelling' ELSE '' END AS meal_logging_reason, CASE
        WHEN c_custkey % 5 = 0 THEN 'Scale broken' ELSE '' END AS weight_logging_reason
        FROM customer
    """,
    "existing_leads": """
        SELECT concat('90000', lpad(CAST(c_custkey AS STRING), 5, '0')) AS phone_key
        FROM customer
        WHERE c_custkey % 11 = 0
    """,
}

# Schemas of the tables below the views; given up front, no file has to be opened to plan a query.
TABLE_SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    ),
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}

_FROM = re.compile(r"\bFROM (\w+)")


def standin_reader(spark: SparkSession, folder: str):
    """Role reader over ``<folder>/<table>.parquet``; every role is planned once."""
    tables: dict[str, DataFrame] = {}
    roles: dict[str, DataFrame] = {}

    def read(role: str) -> DataFrame:
        if role not in roles:
            name = _FROM.search(ROLE_VIEWS[role]).group(1)
            if name not in tables:
                tables[name] = spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")
            roles[role] = spark.sql(_FROM.sub(r"FROM {\1}", ROLE_VIEWS[role]), **{name: tables[name]})
        return roles[role]

    return read
