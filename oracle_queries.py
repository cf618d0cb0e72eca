"""DuckDB SQL for every registered query, written independently of the Spark plans.

Foreign keys are literal NOT IN subqueries, duplicates are a UNION ALL, the latest run is a
QUALIFY, and each table is aggregated in one statement.
"""

from __future__ import annotations

from tablegauge.sources.seeds import FRESHNESS_RULE_SEEDS, THRESHOLD_SEEDS

_NOW = "TIMESTAMP '2024-01-31 06:00:00'"
_DAY = "DATE '2024-01-31'"

_CREATED = """CASE WHEN {k} % 139 = 11 THEN CAST(DATE '2024-01-31' + 1 AS TIMESTAMP)
  ELSE CAST(DATE '2024-01-31' - CAST(5 + {k} % 400 AS INT) AS TIMESTAMP) END"""
_RUN = "CASE WHEN {k} % 10 = 0 THEN 'RUN_20240130_01' ELSE 'RUN_20240131_01' END"

_SPINE = f"""person_spine AS (SELECT 'LCV1-S1-D01' AS decision_id,
 {_RUN.format(k="c_custkey")} AS run_id,
 CASE WHEN c_custkey % 97 = 1 THEN NULL WHEN c_custkey % 89 = 2 THEN CAST(c_custkey - 1 AS VARCHAR)
   ELSE CAST(c_custkey AS VARCHAR) END AS person_id,
 CASE WHEN c_custkey % 101 = 3 THEN NULL ELSE c_mktsegment END AS identity_type_used,
 CASE WHEN c_custkey % 103 = 4 THEN NULL ELSE 'SRC' || c_nationkey END AS src_system_cd,
 CASE WHEN c_custkey % 107 = 5 THEN NULL ELSE c_name END AS src_customer_id,
 CASE WHEN c_custkey % 109 = 6 THEN NULL ELSE {_CREATED.format(k="c_custkey")} END
   AS record_created_ts,
 CASE WHEN c_custkey % 113 = 7 THEN NULL
   ELSE CAST({_DAY} - CAST(c_custkey % 5 AS INT) AS TIMESTAMP) END AS record_updated_ts,
 {_DAY} - CAST(c_custkey % 300 AS INT) AS first_seen_date,
 {_DAY} - CAST(c_custkey % 310 AS INT) AS last_seen_date,
 CASE WHEN c_custkey % 61 = 8 THEN NULL
   ELSE {_DAY} - CAST(3650 + c_custkey * 17 % 25000 AS INT) END AS date_of_birth,
 CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'SSN' || c_custkey END AS ssn,
 c_acctbal >= 0 AS is_active,
 CASE WHEN c_custkey % 127 = 9 THEN NULL ELSE 'v1' END AS decision_version
 FROM customer)"""

_XREF = f"""person_identifier_xref AS (SELECT 'LCV1-S1-D02' AS decision_id,
 {_RUN.format(k="o_orderkey")} AS run_id,
 CASE WHEN o_orderkey % 211 = 1 THEN NULL ELSE o_orderstatus END AS src_system_cd,
 o_orderpriority AS source_identifier_type,
 CAST(o_orderkey AS VARCHAR) AS source_identifier_value,
 CASE WHEN o_orderkey % 227 = 3 THEN NULL
   WHEN o_orderkey % 229 = 4 THEN CAST(o_custkey + 100000000 AS VARCHAR)
   ELSE CAST(o_custkey AS VARCHAR) END AS person_id,
 CASE WHEN o_orderkey % 233 = 5 THEN NULL ELSE {_CREATED.format(k="o_orderkey")} END
   AS record_created_ts,
 CAST({_DAY} - CAST(o_orderkey % 5 AS INT) AS TIMESTAMP) AS record_updated_ts,
 CASE WHEN o_orderkey % 239 = 6 THEN {_DAY} + 1 ELSE CAST(o_orderdate AS DATE) END
   AS effective_start_date,
 CASE WHEN o_orderstatus = 'F' THEN {_DAY} - CAST(o_orderkey % 30 AS INT) END
   AS effective_end_date
 FROM orders
 UNION ALL
 SELECT 'LCV1-S1-D02', 'RUN_20240131_01', o_orderstatus, o_orderpriority,
 CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), CAST({_DAY} AS TIMESTAMP),
 CAST({_DAY} AS TIMESTAMP), CAST(o_orderdate AS DATE), CAST(NULL AS DATE)
 FROM orders WHERE o_orderkey % 223 = 2)"""

_BEHAVIOR = f"""customer_behavior_daily AS (SELECT 'LCV1-S1-D03' AS decision_id,
 CASE WHEN event_id % 401 = 1 THEN NULL
   WHEN event_id % 409 = 2 THEN CAST(user_id + 100000000 AS VARCHAR)
   ELSE CAST(user_id AS VARCHAR) END AS person_id,
 CASE WHEN event_id % 419 = 3 THEN NULL ELSE CAST(ts AS DATE) END AS business_date,
 CASE WHEN event_id % 421 = 4 THEN NULL ELSE event_type END AS src_system_cd,
 CASE WHEN event_id % 431 = 5 THEN NULL ELSE value >= 20 END AS is_active_customer_flag,
 CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS last_activity_date,
 CASE WHEN event_id % 433 < 60 THEN NULL ELSE CAST(event_id % 30 AS INT) END
   AS days_since_inactive,
 CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'SSN' || user_id END AS ssn,
 CASE WHEN event_id % 443 = 6 THEN CAST({_DAY} AS TIMESTAMP) ELSE ts END AS record_created_ts,
 ts AS record_updated_ts
 FROM events)"""

_CONTACT = f"""person_contact_profile AS (SELECT 'LCV1-S1-D12' AS decision_id,
 {_RUN.format(k="c_custkey")} AS run_id,
 CASE WHEN c_custkey % 97 = 1 THEN NULL
   WHEN c_custkey % 79 = 2 THEN CAST(c_custkey + 100000000 AS VARCHAR)
   ELSE CAST(c_custkey AS VARCHAR) END AS person_id,
 'SRC' || c_nationkey AS src_system_cd,
 CASE WHEN c_custkey % 131 = 10 THEN NULL ELSE c_acctbal >= 0 END AS is_active,
 CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN c_name || '.example'
   ELSE c_name || '@x.example' END AS primary_email_address,
 CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS primary_email_valid_flag,
 CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN '555-0101'
   ELSE '(555) 123-4567' END AS primary_phone_number,
 1 AS primary_phone_valid_flag,
 CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 29 = 0 THEN 'TEX' ELSE 'TX' END
   AS mailing_address_state_cd,
 CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE c_custkey || ' Main St' END
   AS mailing_address_line1,
 CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE 'F' END AS first_name,
 CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE 'L' END AS last_name,
 CASE WHEN c_custkey % 109 = 6 THEN NULL ELSE {_CREATED.format(k="c_custkey")} END
   AS record_created_ts,
 CAST({_DAY} - CAST(c_custkey % 5 AS INT) AS TIMESTAMP) AS record_updated_ts
 FROM customer)"""

_PCT = "CASE WHEN {d} = 0 THEN 0.0 ELSE CAST({n} AS DOUBLE) / {d} * 100 END"
_LATE = "record_created_ts > record_updated_ts"
_MISSING = "person_id IS NOT NULL AND person_id NOT IN (SELECT person_id FROM person_spine)"
_MISSING_ANTI = """person_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM person_spine s WHERE s.person_id = {t}.person_id)"""


def _n(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


# Check -> aggregate, over the columns of the table plus t (rows in scope) and k (distinct keys).
_SPINE_CHECKS = {
    "REQ_PERSON_ID": _n("person_id IS NULL"),
    "UNQ_PERSON_ID": "greatest(count(*) - count(DISTINCT person_id), 0)",
    "REQ_IDENTITY_TYPE_USED": _n("identity_type_used IS NULL"),
    "REQ_SRC_SYSTEM_CD": _n("src_system_cd IS NULL"),
    "REQ_SRC_CUSTOMER_ID": _n("src_customer_id IS NULL"),
    "REQ_CREATE_TS": _n("record_created_ts IS NULL"),
    "LOG_CREATE_LS_UPDATE_TS": _n(_LATE),
    "REQ_DECISION_VERSION": _n("decision_version IS NULL"),
    "LOG_FIRST_LS_LAST_SEEN": _n("first_seen_date > last_seen_date"),
    "LOG_DOB": _n("2024 - year(date_of_birth) < 18"),
    "THR_SSN_NULL": _n("ssn IS NULL"),
    "THR_DOB_NULL": _n("date_of_birth IS NULL"),
    "THR_IS_ACTIVE_FALSE": _n("is_active = FALSE"),
    "THR_RECORD_DROP_PCT": _PCT.format(
        n=_n(f"is_active = FALSE AND CAST(record_updated_ts AS DATE) = {_DAY}"), d="count(*)"
    ),
}
_SPINE_META = {"TOTAL_VOL": "count(*)", "DISTINCT_PERSON_ID": "count(DISTINCT person_id)"}


def _xref_checks(scope: str) -> dict[str, str]:
    rows = _n(scope)
    # A NULL part makes the whole text NULL, so the key is not counted.
    keys = f"""count(DISTINCT src_system_cd || '|' || source_identifier_type || '|'
      || source_identifier_value || '|' || person_id) FILTER (WHERE {scope})"""
    return {
        "TOTAL_VOL": rows,
        "DISTINCT_PK": keys,
        "REQ_PK": _n(f"""{scope} AND (src_system_cd IS NULL OR source_identifier_type IS NULL
          OR source_identifier_value IS NULL OR person_id IS NULL)"""),
        "UNQ_PK": f"greatest({rows} - {keys}, 0)",
        "REQ_PERSON_ID_EXISTS": _n(f"{scope} AND {_MISSING}"),
        "REQ_CREATE_TS": _n(f"{scope} AND record_created_ts IS NULL"),
        "LOG_CREATE_LS_UPDATE_TS": _n(f"{scope} AND {_LATE}"),
        "LOG_EFFECTIVE_START_LS_END_TS": _n("effective_start_date > effective_end_date"),
        "THR_RECORD_DROP_PCT": _PCT.format(n=_n(f"effective_end_date = {_DAY}"), d="count(*)"),
    }


_BEHAVIOR_KEYS = "count(DISTINCT person_id || '|' || business_date)"
_BEHAVIOR_CHECKS = {
    "TOTAL_VOL": "count(*)",
    "DISTINCT_PK": _BEHAVIOR_KEYS,
    "REQ_PK": _n("person_id IS NULL OR business_date IS NULL"),
    "UNQ_PK": f"greatest(count(*) - {_BEHAVIOR_KEYS}, 0)",
    "REQ_PERSON_ID_EXISTS": _n(_MISSING),
    "REQ_SRC_SYSTEM_CD": _n("src_system_cd IS NULL"),
    "REQ_IS_ACTIVE_FLAG": _n("is_active_customer_flag IS NULL"),
    "DEP_INACTIVE_REQUIRES_DAYS": _n("""is_active_customer_flag = FALSE
      AND last_activity_date IS NOT NULL AND days_since_inactive IS NULL"""),
    "LOG_CREATE_LS_UPDATE_TS": _n(_LATE),
    "THR_SSN_NULL": _n("ssn IS NULL"),
    "THR_RECORD_DROP_PCT": _PCT.format(
        n=f"({_n(f'business_date = {_DAY} - 2')} - {_n(f'business_date = {_DAY} - 1')})",
        d=_n(f"business_date = {_DAY} - 2"),
    ),
}

_CONTACT_ROWS = "sum(CASE WHEN is_active = TRUE THEN 1 ELSE 0 END)"
_CONTACT_KEYS = (
    "count(DISTINCT CASE WHEN is_active = TRUE THEN person_id || '-' || src_system_cd END)"
)


def _coverage(column: str) -> str:
    return _PCT.format(n=_n(f"record_updated_ts >= {_DAY} AND {column} IS NULL"), d=_CONTACT_KEYS)


_CONTACT_CHECKS = {
    "REQ_PK": _n("is_active = TRUE AND (person_id IS NULL OR src_system_cd IS NULL)"),
    "UNQ_PK": f"greatest({_CONTACT_ROWS} - {_CONTACT_KEYS}, 0)",
    "REQ_PERSON_ID_EXISTS": _n(f"is_active = TRUE AND {_MISSING}"),
    "REQ_RECORD_CREATED_TS": _n("is_active = TRUE AND record_created_ts IS NULL"),
    "LOG_RECORD_CREATED_LS_UPDATED": _n(f"is_active = TRUE AND {_LATE}"),
    "VAL_EMAIL_FORMAT": _n("""is_active = TRUE AND primary_email_valid_flag = 1
      AND primary_email_address NOT LIKE '%@%'"""),
    "VAL_PHONE_FORMAT": _n("""is_active = TRUE AND primary_phone_valid_flag = 1
      AND length(regexp_replace(primary_phone_number, '[^0-9]', '', 'g')) < 10"""),
    "VAL_STATE_CODE": _n("is_active = TRUE AND length(mailing_address_state_cd) <> 2"),
    "THR_EMAIL_COVERAGE_DROP": _coverage("primary_email_address"),
    "THR_PHONE_COVERAGE_DROP": _coverage("primary_phone_number"),
    "THR_ADDRESS_COVERAGE_DROP": _coverage("mailing_address_line1"),
    "THR_RECORD_DROP_PCT": _PCT.format(
        n=_n(f"is_active = FALSE AND CAST(record_updated_ts AS DATE) = {_DAY}"), d=_CONTACT_KEYS
    ),
    "THR_NAME_NULL": _n("first_name IS NULL OR last_name IS NULL"),
}
_CONTACT_META = {"TOTAL_VOL": _CONTACT_ROWS, "DISTINCT_PK": _CONTACT_KEYS}


def _long(table: str, label: str, checks: dict[str, str], by: str = "decision_id", where="") -> str:
    """SELECT of (decision_id, table_name, check_name, check_value)."""
    metrics = ",\n  ".join(f'CAST({sql} AS DOUBLE) AS "{name}"' for name, sql in checks.items())
    return f"""SELECT decision_id, '{label}' AS table_name, check_name, check_value FROM (
 UNPIVOT (SELECT {by} AS decision_id,
  {metrics}
  FROM {table} {where} GROUP BY ALL)
 ON COLUMNS(* EXCLUDE decision_id) INTO NAME check_name VALUE check_value)"""


def _each(table: str, label: str, checks: dict[str, str], by: str = "decision_id") -> str:
    """The same, a SELECT for each check: for names that are no column names."""
    return "\nUNION ALL ".join(
        f"SELECT {by} AS decision_id, '{label}' AS table_name, '{name}' AS check_name, "
        f"CAST({sql} AS DOUBLE) AS check_value FROM {table} GROUP BY {by}"
        for name, sql in checks.items()
    )


_OPEN = "WHERE effective_end_date IS NULL"
_SUMMARIES = {
    "spine": _long("person_spine", "PERSON_SPINE", _SPINE_CHECKS),
    "xref": _long(
        "person_identifier_xref", "PERSON_IDENTIFIER_XREF", _xref_checks("TRUE"), where=_OPEN
    ),
    "behavior": _long("customer_behavior_daily", "CUSTOMER_BEHAVIOR_DAILY", _BEHAVIOR_CHECKS),
    "contact": _long("person_contact_profile", "PERSON_CONTACT_PROFILE", _CONTACT_CHECKS),
}
_XREF_UNSCOPED = _long(
    "person_identifier_xref",
    "PERSON_IDENTIFIER_XREF",
    _xref_checks("effective_end_date IS NULL"),
)
_TABLES = f"WITH {_SPINE},\n{_XREF},\n{_BEHAVIOR},\n{_CONTACT}"


def _literal(value) -> str:
    if value is None:
        return "NULL"
    return str(value) if isinstance(value, int) else f"'{value}'"


def _thresholds(*, without: tuple[str, str] | None = None, extra: str = "") -> str:
    """Active thresholds: the seeds, less a (table, check), plus an extra row."""
    rows = [
        f"('{table}', '{check}', '{decision}', '{severity}', {value})"
        for (table, decision), checks in THRESHOLD_SEEDS.items()
        for check, severity, _, value, _, _ in checks
        if (table, check) != without
    ]
    rows += [extra] if extra else []
    return f"""thresholds AS (SELECT * FROM (VALUES {", ".join(rows)})
 v(table_name, check_name, decision_id, severity, threshold_value))"""


def _audit(
    summary: str, thresholds: str | None = None, tables: str = _TABLES, by_table: bool = True
) -> str:
    match_table = "AND s.table_name = t.table_name" if by_table else ""
    return f"""{tables}, {thresholds or _thresholds()}, summary AS ({summary})
SELECT s.decision_id || '_20240131060000' AS dq_run_id, s.table_name AS pipeline_name,
 s.decision_id, {_DAY} AS business_date, s.check_name, t.severity,
 CAST(round(s.check_value) AS BIGINT) AS violation_count,
 CAST(t.threshold_value AS BIGINT) AS threshold,
 CASE WHEN s.check_value <= t.threshold_value THEN 'PASSED'
   WHEN s.check_value > t.threshold_value THEN t.severity ELSE 'UNKNOWN' END AS status,
 {_NOW} AS created_ts, s.check_value
FROM summary s JOIN thresholds t
 ON s.check_name = t.check_name AND s.decision_id = t.decision_id {match_table}
WHERE s.check_name NOT IN ('TOTAL_VOL', 'DISTINCT_PERSON_ID', 'DISTINCT_PK')"""


def _all(parts) -> str:
    return "\nUNION ALL\n".join(parts)


_ALL_ANTI = _all(
    [
        _SUMMARIES["spine"],
        *[
            sql.replace(_MISSING, _MISSING_ANTI.format(t=table))
            for sql, table in [
                (_SUMMARIES["xref"], "person_identifier_xref"),
                (_SUMMARIES["behavior"], "customer_behavior_daily"),
                (_SUMMARIES["contact"], "person_contact_profile"),
            ]
        ],
    ]
)
_FK_TABLES = [
    ("person_identifier_xref", "PERSON_IDENTIFIER_XREF"),
    ("customer_behavior_daily", "CUSTOMER_BEHAVIOR_DAILY"),
    ("person_contact_profile", "PERSON_CONTACT_PROFILE"),
]


def _fk(missing: str) -> str:
    return f"{_TABLES}\n" + _all(
        _long(table, label, {"PERSON_ID_EXISTS": _n(missing.format(t=table))})
        for table, label in _FK_TABLES
    )


def _latest(table: str) -> str:
    return f"""SELECT decision_id, run_id, max(CAST(record_updated_ts AS DATE)) AS last_updated_date
 FROM {table} GROUP BY decision_id, run_id
 QUALIFY row_number() OVER (PARTITION BY decision_id ORDER BY run_id DESC NULLS FIRST) = 1"""


def _run_freshness(table: str, label: str) -> str:
    return f"""SELECT decision_id, run_id, {_NOW} AS checked_ts, '{label}' AS target_table,
 rule_name, actual_value FROM (
 UNPIVOT (SELECT decision_id, run_id, CAST(last_updated_date AS VARCHAR) AS "TABLE_FRESHNESS",
  CAST(CAST(try_strptime(substring(run_id, 5, 8), '%Y%m%d') AS DATE) AS VARCHAR)
    AS "RUN_ID_FRESHNESS" FROM ({_latest(table)}))
 ON "TABLE_FRESHNESS", "RUN_ID_FRESHNESS" INTO NAME rule_name VALUE actual_value)"""


_FRESHNESS = {
    "spine": _run_freshness("person_spine", "PERSON_SPINE"),
    "xref": _run_freshness("person_identifier_xref", "PERSON_IDENTIFIER_XREF"),
    "behavior": f"""SELECT decision_id, run_id, {_NOW} AS checked_ts,
 'CUSTOMER_BEHAVIOR_DAILY' AS target_table, rule_name, actual_value FROM (
 UNPIVOT (SELECT decision_id, CAST(NULL AS VARCHAR) AS run_id,
  CAST(max(CAST(record_updated_ts AS DATE)) AS VARCHAR) AS "TABLE_FRESHNESS",
  CAST({_DAY} - max(business_date) AS VARCHAR) AS "LAG_DAY"
  FROM customer_behavior_daily GROUP BY ALL)
 ON "TABLE_FRESHNESS", "LAG_DAY" INTO NAME rule_name VALUE actual_value)""",
    "contact": _run_freshness("person_contact_profile", "PERSON_CONTACT_PROFILE"),
}


def _rules(replaced: tuple[str, str] | None = None, extra: str = "") -> str:
    rows = [
        f"('{decision}', '{rule}', {_literal(lag)}, '{severity}')"
        for (_, decision), rule, _, lag, _, severity, _ in FRESHNESS_RULE_SEEDS
        if (decision, rule) != replaced
    ]
    rows += [extra] if extra else []
    return f"""rules AS (SELECT * FROM (VALUES {", ".join(rows)})
 v(decision_id, rule_name, lag, severity))"""


def _exact(summary: str) -> str:
    return f"""SELECT s.run_id, s.checked_ts, s.rule_name, s.decision_id, s.target_table,
 CAST({_DAY} AS VARCHAR) AS expected_value, s.actual_value, r.severity,
 CASE WHEN s.actual_value = CAST({_DAY} AS VARCHAR) THEN 'PASSED' ELSE r.severity END AS status,
 'Checked at 2024-01-31 06:00:00' AS details
FROM ({summary}) s JOIN rules r USING (decision_id, rule_name)"""


def _tolerant(summary: str) -> str:
    return f"""SELECT s.run_id, s.checked_ts, s.rule_name, s.decision_id, s.target_table,
 CASE s.rule_name
   WHEN 'TABLE_FRESHNESS' THEN CAST({_DAY} - CAST(coalesce(r.lag, 0) AS INT) AS VARCHAR)
   WHEN 'LAG_DAY' THEN CAST(coalesce(r.lag, 0) AS VARCHAR) END AS expected_value,
 s.actual_value, r.severity,
 CASE WHEN s.rule_name = 'TABLE_FRESHNESS'
   AND TRY_CAST(s.actual_value AS DATE) >= {_DAY} - CAST(coalesce(r.lag, 0) AS INT) THEN 'PASSED'
   WHEN s.rule_name = 'LAG_DAY' AND TRY_CAST(s.actual_value AS INT) <= coalesce(r.lag, 0)
   THEN 'PASSED' ELSE r.severity END AS status,
 'Checked at 2024-01-31 06:00:00' AS details
FROM ({summary}) s JOIN rules r USING (decision_id, rule_name)"""


_FRESHNESS_AUDITS = {
    name: _tolerant(sql) if name == "behavior" else _exact(sql) for name, sql in _FRESHNESS.items()
}

_PART_THRESHOLDS = """SELECT p_partkey AS threshold_id, p_brand AS table_name,
 p_name AS check_name, p_type AS decision_id,
 CASE WHEN p_size <= 20 THEN 'FAIL' WHEN p_size <= 40 THEN 'WARN' ELSE 'INFO' END AS severity,
 'ABSOLUTE_COUNT' AS threshold_type, CAST(p_size AS BIGINT) AS threshold_value,
 CAST(NULL AS BIGINT) AS lookback_days, p_retailprice < 1500 AS is_active,
 TIMESTAMP '2024-01-01 00:00:00' AS created_ts, TIMESTAMP '2024-01-01 00:00:00' AS updated_ts,
 CAST(NULL AS VARCHAR) AS notes FROM part"""

_SUPPLIER_RULES = """SELECT 'NATION_' || s_nationkey AS target_table, s_name AS decision_id,
 CASE WHEN s_acctbal < 5000 THEN 'LAG_DAY' ELSE 'TABLE_FRESHNESS' END AS rule_name,
 'RECORD_UPDATED_TS' AS date_column, s_nationkey AS expected_lag_days, 6 AS sla_hour_et,
 'FAIL' AS severity, s_acctbal >= 0 AS is_active,
 TIMESTAMP '2024-01-01 00:00:00' AS created_ts, TIMESTAMP '2024-01-01 00:00:00' AS updated_ts,
 CAST(NULL AS VARCHAR) AS notes FROM supplier"""

_THRESHOLD_HISTORY = f"""WITH config AS ({_PART_THRESHOLDS}),
changed AS (SELECT *, is_active AND ((table_name = 'Brand#2' AND check_name = 'small ring')
  OR (table_name = 'Brand#4' AND check_name = 'blue bolt')) AS hit FROM config),
new AS (SELECT * FROM (VALUES
 (1, 'Brand#2', 'small ring', 'ECONOMY', 7, NULL, FALSE, 'first'),
 (2, 'Brand#4', 'blue bolt', 'SMALL', 8, 1, TRUE, 'second'),
 (3, 'Brand#2', 'small ring', 'ECONOMY', 9, NULL, TRUE, 'third'))
 v(n, table_name, check_name, decision_id, threshold_value, lookback_days, is_active, notes))
SELECT threshold_id, table_name, check_name, decision_id, severity, threshold_type,
 threshold_value, lookback_days, is_active AND NOT hit AS is_active, created_ts,
 CASE WHEN hit THEN {_NOW} ELSE updated_ts END AS updated_ts, notes FROM changed
UNION ALL
SELECT (SELECT max(threshold_id) FROM config) + n, table_name, check_name, decision_id, 'WARN',
 'ABSOLUTE_COUNT', CAST(threshold_value AS BIGINT), CAST(lookback_days AS BIGINT), is_active,
 {_NOW}, {_NOW}, notes FROM new"""

_RULE_HISTORY = f"""WITH config AS ({_SUPPLIER_RULES}),
changed AS (SELECT *, is_active AND decision_id = 'Supplier#000000000'
  AND rule_name = 'TABLE_FRESHNESS' AS hit FROM config)
SELECT target_table, decision_id, rule_name, date_column, expected_lag_days, sla_hour_et,
 severity, is_active AND NOT hit AS is_active, created_ts,
 CASE WHEN hit THEN {_NOW} ELSE updated_ts END AS updated_ts, notes FROM changed
UNION ALL
SELECT 'NATION_15', 'Supplier#000000000', 'TABLE_FRESHNESS', 'RECORD_UPDATED_TS', 3, NULL,
 'WARN', TRUE, {_NOW}, {_NOW}, 'relaxed'"""

_BY_PART = _audit(
    _long(
        "lineitem",
        "LINEITEM",
        {
            "UNQ_LINE": """greatest(count(*)
              - count(DISTINCT l_orderkey || '|' || l_linenumber), 0)""",
            "LOG_DISCOUNT_LE_TAX": _n("l_discount > l_tax"),
            "THR_RETURNED_PCT": _PCT.format(n=_n("l_returnflag = 'R'"), d="count(*)"),
        },
        by="CAST(l_partkey AS VARCHAR)",
    ),
    thresholds="""thresholds AS (SELECT 'LINEITEM' AS table_name, check_name,
 CAST(p_partkey AS VARCHAR) AS decision_id,
 CASE WHEN p_size <= 20 THEN 'FAIL' ELSE 'WARN' END AS severity, p_size AS threshold_value
 FROM part, (VALUES ('UNQ_LINE'), ('LOG_DISCOUNT_LE_TAX'), ('THR_RETURNED_PCT')) c(check_name)
 WHERE p_retailprice < 1500)""",
)

_LABELLED = "(SELECT * FROM documents LEFT JOIN labels USING (doc_id))"
_KNOWN = "SELECT p_partkey + 100 FROM part"
_UNKNOWN_PART = f"l_partkey NOT IN ({_KNOWN})"
_UNKNOWN_OR_NULL = f"l_partkey NOT IN ({_KNOWN} WHERE p_partkey % 7 <> 0)"

_XREF_KEY_NULL = """(src_system_cd IS NULL OR source_identifier_type IS NULL
 OR source_identifier_value IS NULL OR person_id IS NULL)"""
_XREF_COLUMNS = ", ".join(
    f"{column} NULLS FIRST"
    for column in """decision_id run_id src_system_cd source_identifier_type source_identifier_value
 person_id record_created_ts record_updated_ts effective_start_date effective_end_date""".split()
)
# Table, its rows in scope, and what makes a row break each check.
_BROKEN = [
    (
        "spine",
        "person_spine",
        "",
        {
            "REQ_PERSON_ID": "person_id IS NULL",
            "REQ_IDENTITY_TYPE_USED": "identity_type_used IS NULL",
            "REQ_SRC_SYSTEM_CD": "src_system_cd IS NULL",
            "REQ_SRC_CUSTOMER_ID": "src_customer_id IS NULL",
            "REQ_CREATE_TS": "record_created_ts IS NULL",
            "LOG_CREATE_LS_UPDATE_TS": _LATE,
            "REQ_DECISION_VERSION": "decision_version IS NULL",
            "LOG_FIRST_LS_LAST_SEEN": "first_seen_date > last_seen_date",
            "LOG_DOB": "2024 - year(date_of_birth) < 18",
            "THR_SSN_NULL": "ssn IS NULL",
            "THR_DOB_NULL": "date_of_birth IS NULL",
            "THR_IS_ACTIVE_FALSE": "is_active = FALSE",
        },
    ),
    (
        "xref",
        "person_identifier_xref",
        _OPEN,
        {
            "REQ_PK": _XREF_KEY_NULL,
            "REQ_CREATE_TS": "record_created_ts IS NULL",
            "LOG_CREATE_LS_UPDATE_TS": _LATE,
            "LOG_EFFECTIVE_START_LS_END_TS": "effective_start_date > effective_end_date",
        },
    ),
    (
        "behavior",
        "customer_behavior_daily",
        "",
        {
            "REQ_PK": "person_id IS NULL OR business_date IS NULL",
            "REQ_SRC_SYSTEM_CD": "src_system_cd IS NULL",
            "REQ_IS_ACTIVE_FLAG": "is_active_customer_flag IS NULL",
            "DEP_INACTIVE_REQUIRES_DAYS": """is_active_customer_flag = FALSE
 AND last_activity_date IS NOT NULL AND days_since_inactive IS NULL""",
            "LOG_CREATE_LS_UPDATE_TS": _LATE,
            "THR_SSN_NULL": "ssn IS NULL",
        },
    ),
    (
        "contact",
        "person_contact_profile",
        "",
        {
            "REQ_PK": "is_active AND (person_id IS NULL OR src_system_cd IS NULL)",
            "REQ_RECORD_CREATED_TS": "is_active AND record_created_ts IS NULL",
            "LOG_RECORD_CREATED_LS_UPDATED": f"is_active AND {_LATE}",
            "VAL_EMAIL_FORMAT": """is_active AND primary_email_valid_flag = 1
 AND primary_email_address NOT LIKE '%@%'""",
            "VAL_PHONE_FORMAT": """is_active AND primary_phone_valid_flag = 1
 AND length(regexp_replace(primary_phone_number, '[^0-9]', '', 'g')) < 10""",
            "VAL_STATE_CODE": "is_active AND length(mailing_address_state_cd) <> 2",
            "THR_NAME_NULL": "first_name IS NULL OR last_name IS NULL",
        },
    ),
]


_KINDS = {
    "check_not_null": _long(
        _LABELLED,
        "DOCUMENTS",
        {
            "REQ_QUALITY": _n("quality IS NULL"),
            "REQ_LABELS_LONG": _n("n_chars > 1000 AND (quality IS NULL OR toxic IS NULL)"),
        },
        by="lang",
    ),
    "check_unique": _long(
        "lineitem",
        "LINEITEM",
        {
            "UNQ_LINE": """greatest(count(*)
              - count(DISTINCT l_orderkey || '|' || l_linenumber), 0)""",
            "UNQ_OPEN_PART": """greatest(count(*) FILTER (WHERE l_linestatus = 'O')
              - count(DISTINCT l_partkey) FILTER (WHERE l_linestatus = 'O'), 0)""",
        },
        by="l_returnflag",
    ),
    "check_foreign_key": _long(
        "lineitem",
        "LINEITEM",
        {"PART_EXISTS": _n(_UNKNOWN_PART), "PART_EXISTS_NULL_AWARE": _n(_UNKNOWN_PART)},
        by="l_returnflag",
    ),
    "check_foreign_key_null": _long(
        "lineitem",
        "LINEITEM",
        {"PART_EXISTS": _n(_UNKNOWN_OR_NULL), "PART_EXISTS_NULL_AWARE": "0 * count(*)"},
        by="l_returnflag",
    ),
    "check_foreign_key_by_order": _long(
        "lineitem",
        "LINEITEM",
        {"PART_EXISTS": _n(_UNKNOWN_PART), "PART_EXISTS_NULL_AWARE": _n(_UNKNOWN_PART)},
        by="CAST(l_orderkey AS VARCHAR)",
    ),
    "check_ordered": _long(
        "lineitem",
        "LINEITEM",
        {"LOG_DISCOUNT_LE_TAX": _n("l_discount > l_tax")},
        by="l_linestatus",
    ),
    "check_min_age": _long(
        "orders", "ORDERS", {"LOG_ORDER_AGE": _n("2024 - year(o_orderdate) < 27")},
        by="o_orderpriority",
    ),
    "check_required_when": _long(
        _LABELLED,
        "DOCUMENTS",
        {"DEP_LONG_REQUIRES_QUALITY": _n("n_chars > 2000 AND quality IS NULL")},
        by="source",
    ),
    "check_matches": _long(
        "documents",
        "DOCUMENTS",
        {
            "VAL_HAS_AT": _n("text NOT LIKE '%@%'"),
            "VAL_TEN_DIGITS": _n("""n_chars > 500
              AND length(regexp_replace(text, '[^0-9]', '', 'g')) < 10"""),
            "VAL_SOURCE_LENGTH": _n("length(source) <> 4"),
        },
        by="lang",
    ),
    "check_count_where": _each(
        "orders",
        "ORDERS",
        {
            "THR_LARGE": _n("o_totalprice > 300000"),
            "THR_LARGE_FILLED": _n("o_orderstatus = 'F' AND o_totalprice > 300000"),
            "orders.o_custkey `even`": _n("o_custkey % 2 = 0"),
            "thr_large": _n("o_totalprice > 200000"),
            "decision_id": _n("o_orderkey % 3 = 0"),
        },
        by="o_orderpriority",
    ),
    "check_deactivated_pct": _long(
        "customer",
        "CUSTOMER",
        {
            "THR_OVERDRAWN_PCT": _PCT.format(n=_n("c_acctbal < 0"), d="count(*)"),
            "THR_OVERDRAWN_PER_NATION": _PCT.format(
                n=_n("c_acctbal < 0"), d="count(DISTINCT c_nationkey)"
            ),
        },
        by="c_mktsegment",
    ),
    "check_period_drop_pct": _long(
        "events",
        "EVENTS",
        {
            "THR_EVENT_DROP_PCT": _PCT.format(
                n=f"""({_n(f"CAST(ts AS DATE) = {_DAY} - 2")}
                  - {_n(f"CAST(ts AS DATE) = {_DAY} - 1")})""",
                d=_n(f"CAST(ts AS DATE) = {_DAY} - 2"),
            )
        },
        by="event_type",
    ),
    "check_coverage_gap_pct": _long(
        "events",
        "EVENTS",
        {
            "THR_VALUE_GAP": _PCT.format(
                n=_n("ts >= DATE '2024-01-30' AND NOT coalesce(value > 10, FALSE)"),
                d="count(DISTINCT user_id)",
            )
        },
        by="event_type",
    ),
}

ORACLE_SQL: dict[str, str] = {
    "dq_summary_person_spine": f"{_TABLES}\n{_SUMMARIES['spine']}",
    "dq_summary_xref": f"{_TABLES}\n{_SUMMARIES['xref']}",
    "dq_summary_behavior": f"{_TABLES}\n{_SUMMARIES['behavior']}",
    "dq_summary_contact": f"{_TABLES}\n{_SUMMARIES['contact']}",
    "dq_summary_spine_metadata": f"{_TABLES}\n"
    + _long("person_spine", "PERSON_SPINE", _SPINE_CHECKS | _SPINE_META),
    "dq_summary_contact_metadata": f"{_TABLES}\n"
    + _long("person_contact_profile", "PERSON_CONTACT_PROFILE", _CONTACT_CHECKS | _CONTACT_META),
    "xref_unscoped": f"{_TABLES}\n{_XREF_UNSCOPED}",
    "dq_audit_person_spine": _audit(_SUMMARIES["spine"]),
    "dq_audit_xref": _audit(_SUMMARIES["xref"]),
    "dq_audit_behavior": _audit(_SUMMARIES["behavior"]),
    "dq_audit_contact": _audit(_SUMMARIES["contact"]),
    "dq_audit_all": _audit(_all(_SUMMARIES.values())),
    "dq_audit_all_anti": _audit(_ALL_ANTI),
    "dq_audit_by_part": _BY_PART,
    "fk_violations_null_aware": _fk(_MISSING),
    "fk_violations_null_aware_clean": _fk(
        _MISSING.replace("person_spine", "person_spine WHERE person_id IS NOT NULL")
    ),
    "fk_violations_anti": _fk(_MISSING_ANTI),
    "fk_violations_prefiltered": _fk(_MISSING_ANTI),
    **{
        f"violating_rows_{table}": f"""{_TABLES} SELECT * FROM (SELECT *, concat_ws(',',
 {", ".join(f"CASE WHEN {broken} THEN '{check}' END" for check, broken in checks.items())}
 ) AS broken_checks FROM {name} {where}) WHERE broken_checks <> ''"""
        for table, name, where, checks in _BROKEN
    },
    "surplus_rows_xref": f"""{_TABLES} SELECT * FROM person_identifier_xref {_OPEN}
 QUALIFY {_XREF_KEY_NULL} OR row_number() OVER (
   PARTITION BY src_system_cd, source_identifier_type, source_identifier_value, person_id
   ORDER BY {_XREF_COLUMNS}) > 1""",
    "period_drop_two_days": _KINDS["check_period_drop_pct"],
    "fk_orphan_rows": f"""{_TABLES} SELECT * FROM person_identifier_xref
 WHERE {_MISSING_ANTI.format(t="person_identifier_xref")}""",
    "latest_run_per_decision": f"{_TABLES}\n"
    + _all(
        f"SELECT * FROM ({_latest(table)})"
        for table in ("person_spine", "person_identifier_xref", "person_contact_profile")
    ),
    **{f"freshness_summary_{name}": f"{_TABLES}\n{sql}" for name, sql in _FRESHNESS.items()},
    **{
        f"freshness_audit_{name}": f"{_TABLES}, {_rules()}\n{sql}"
        for name, sql in _FRESHNESS_AUDITS.items()
    },
    "freshness_audit_all": f"{_TABLES}, {_rules()}\n{_all(_FRESHNESS_AUDITS.values())}",
    "threshold_update_value": _audit(
        _SUMMARIES["spine"],
        _thresholds(
            without=("PERSON_SPINE", "THR_SSN_NULL"),
            extra="('PERSON_SPINE', 'THR_SSN_NULL', 'LCV1-S1-D01', 'WARN', 150)",
        ),
    ),
    "threshold_update_severity": _audit(
        _XREF_UNSCOPED,
        _thresholds(
            without=("PERSON_IDENTIFIER_XREF", "LOG_EFFECTIVE_START_LS_END_TS"),
            extra="""('PERSON_IDENTIFIER_XREF', 'LOG_EFFECTIVE_START_LS_END_TS',
              'LCV1-S1-D02', 'FAIL', 0)""",
        ),
    ),
    "threshold_fanout": _audit(
        _SUMMARIES["behavior"],
        _thresholds(
            extra="""('CUSTOMER_BEHAVIOR_DAILY_SNAPSHOT', 'THR_RECORD_DROP_PCT',
              'LCV1-S1-D03', 'WARN', 5)"""
        ),
        by_table=False,
    ),
    "freshness_rule_update": f"""{_TABLES}, {
        _rules(("LCV1-S1-D03", "LAG_DAY"), "('LCV1-S1-D03', 'LAG_DAY', 2, 'WARN')")
    }
{_tolerant(_FRESHNESS["behavior"])}""",
    "thresholds_rollup": f"""SELECT table_name, count(*) AS total_checks,
 CAST(sum(CASE WHEN severity = 'FAIL' THEN 1 ELSE 0 END) AS BIGINT) AS fail_checks,
 CAST(sum(CASE WHEN severity = 'WARN' THEN 1 ELSE 0 END) AS BIGINT) AS warn_checks,
 CAST(sum(CASE WHEN is_active = TRUE THEN 1 ELSE 0 END) AS BIGINT) AS active_checks
FROM ({_PART_THRESHOLDS}) GROUP BY table_name ORDER BY table_name""",
    "active_thresholds": f"SELECT * FROM ({_PART_THRESHOLDS}) WHERE is_active",
    "active_rules": f"SELECT * FROM ({_SUPPLIER_RULES}) WHERE is_active",
    "threshold_history": _THRESHOLD_HISTORY,
    "freshness_rule_history": _RULE_HISTORY,
    **_KINDS,
}
