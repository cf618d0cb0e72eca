"""The four profiled tables, derived from the star schema with known defects.

The star tables hold no NULLs, so defects are placed by arithmetic on the keys. Every source row
is kept, and the identifier links gain a duplicate for some orders. The clock is fixed.
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tablegauge.sources.tables import load_table

AS_OF_TS = datetime(2024, 1, 31, 6, 0, 0)

_TODAY = "DATE '2024-01-31'"


def _created(key: str) -> str:
    return f"""CASE WHEN {key} % 139 = 11 THEN CAST({_TODAY} + 1 AS TIMESTAMP_NTZ)
        ELSE CAST({_TODAY} - CAST(5 + {key} % 400 AS INT) AS TIMESTAMP_NTZ) END"""


def _run(key: str) -> str:
    return f"CASE WHEN {key} % 10 = 0 THEN 'RUN_20240130_01' ELSE 'RUN_20240131_01' END"


def star_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_table(spark, f"{sf_dir}/{name}.parquet")


def person_spine(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(
        "'LCV1-S1-D01' AS decision_id",
        f"{_run('c_custkey')} AS run_id",
        """CASE WHEN c_custkey % 97 = 1 THEN NULL
            WHEN c_custkey % 89 = 2 THEN CAST(c_custkey - 1 AS STRING)
            ELSE CAST(c_custkey AS STRING) END AS person_id""",
        "CASE WHEN c_custkey % 101 = 3 THEN NULL ELSE c_mktsegment END AS identity_type_used",
        """CASE WHEN c_custkey % 103 = 4 THEN NULL
            ELSE concat('SRC', CAST(c_nationkey AS STRING)) END AS src_system_cd""",
        "CASE WHEN c_custkey % 107 = 5 THEN NULL ELSE c_name END AS src_customer_id",
        f"""CASE WHEN c_custkey % 109 = 6 THEN NULL ELSE {_created("c_custkey")} END
            AS record_created_ts""",
        f"""CASE WHEN c_custkey % 113 = 7 THEN NULL
            ELSE CAST({_TODAY} - CAST(c_custkey % 5 AS INT) AS TIMESTAMP_NTZ) END
            AS record_updated_ts""",
        f"{_TODAY} - CAST(c_custkey % 300 AS INT) AS first_seen_date",
        f"{_TODAY} - CAST(c_custkey % 310 AS INT) AS last_seen_date",
        f"""CASE WHEN c_custkey % 61 = 8 THEN NULL
            ELSE {_TODAY} - CAST(3650 + c_custkey * 17 % 25000 AS INT) END AS date_of_birth""",
        """CASE WHEN c_custkey % 7 = 0 THEN NULL
            ELSE concat('SSN', CAST(c_custkey AS STRING)) END AS ssn""",
        "c_acctbal >= 0 AS is_active",
        "CASE WHEN c_custkey % 127 = 9 THEN NULL ELSE 'v1' END AS decision_version",
    )


def person_identifier_xref(orders: DataFrame) -> DataFrame:
    """One link per order, and a clean second link (copy 1) for the orders that duplicate."""
    copies = orders.selectExpr(
        "*",
        """explode(CASE WHEN o_orderkey % 223 = 2 THEN array(0, 1) ELSE array(0) END)
            AS copy""",
    )
    return copies.selectExpr(
        "'LCV1-S1-D02' AS decision_id",
        f"CASE WHEN copy = 1 THEN 'RUN_20240131_01' ELSE {_run('o_orderkey')} END AS run_id",
        """CASE WHEN copy = 0 AND o_orderkey % 211 = 1 THEN NULL ELSE o_orderstatus END
            AS src_system_cd""",
        "o_orderpriority AS source_identifier_type",
        "CAST(o_orderkey AS STRING) AS source_identifier_value",
        """CASE WHEN copy = 0 AND o_orderkey % 227 = 3 THEN NULL
            WHEN copy = 0 AND o_orderkey % 229 = 4 THEN CAST(o_custkey + 100000000 AS STRING)
            ELSE CAST(o_custkey AS STRING) END AS person_id""",
        f"""CASE WHEN copy = 1 THEN CAST({_TODAY} AS TIMESTAMP_NTZ)
            WHEN o_orderkey % 233 = 5 THEN NULL ELSE {_created("o_orderkey")} END
            AS record_created_ts""",
        f"""CASE WHEN copy = 1 THEN CAST({_TODAY} AS TIMESTAMP_NTZ)
            ELSE CAST({_TODAY} - CAST(o_orderkey % 5 AS INT) AS TIMESTAMP_NTZ) END
            AS record_updated_ts""",
        f"""CASE WHEN copy = 0 AND o_orderkey % 239 = 6 THEN {_TODAY} + 1
            ELSE CAST(o_orderdate AS DATE) END AS effective_start_date""",
        f"""CASE WHEN copy = 0 AND o_orderstatus = 'F'
            THEN {_TODAY} - CAST(o_orderkey % 30 AS INT) END AS effective_end_date""",
    )


def customer_behavior_daily(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "'LCV1-S1-D03' AS decision_id",
        """CASE WHEN event_id % 401 = 1 THEN NULL
            WHEN event_id % 409 = 2 THEN CAST(user_id + 100000000 AS STRING)
            ELSE CAST(user_id AS STRING) END AS person_id""",
        "CASE WHEN event_id % 419 = 3 THEN NULL ELSE CAST(ts AS DATE) END AS business_date",
        "CASE WHEN event_id % 421 = 4 THEN NULL ELSE event_type END AS src_system_cd",
        "CASE WHEN event_id % 431 = 5 THEN NULL ELSE value >= 20 END AS is_active_customer_flag",
        "CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS last_activity_date",
        """CASE WHEN event_id % 433 < 60 THEN NULL ELSE CAST(event_id % 30 AS INT) END
            AS days_since_inactive""",
        """CASE WHEN event_id % 5 = 0 THEN NULL
            ELSE concat('SSN', CAST(user_id AS STRING)) END AS ssn""",
        f"""CASE WHEN event_id % 443 = 6 THEN CAST({_TODAY} AS TIMESTAMP_NTZ) ELSE ts END
            AS record_created_ts""",
        "ts AS record_updated_ts",
    )


def person_contact_profile(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(
        "'LCV1-S1-D12' AS decision_id",
        f"{_run('c_custkey')} AS run_id",
        """CASE WHEN c_custkey % 97 = 1 THEN NULL
            WHEN c_custkey % 79 = 2 THEN CAST(c_custkey + 100000000 AS STRING)
            ELSE CAST(c_custkey AS STRING) END AS person_id""",
        "concat('SRC', CAST(c_nationkey AS STRING)) AS src_system_cd",
        "CASE WHEN c_custkey % 131 = 10 THEN NULL ELSE c_acctbal >= 0 END AS is_active",
        """CASE WHEN c_custkey % 11 = 0 THEN NULL
            WHEN c_custkey % 13 = 0 THEN concat(c_name, '.example')
            ELSE concat(c_name, '@x.example') END AS primary_email_address""",
        "CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS primary_email_valid_flag",
        """CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN '555-0101'
            ELSE '(555) 123-4567' END AS primary_phone_number""",
        "1 AS primary_phone_valid_flag",
        """CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 29 = 0 THEN 'TEX'
            ELSE 'TX' END AS mailing_address_state_cd""",
        """CASE WHEN c_custkey % 31 = 0 THEN NULL
            ELSE concat(CAST(c_custkey AS STRING), ' Main St') END AS mailing_address_line1""",
        "CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE 'F' END AS first_name",
        "CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE 'L' END AS last_name",
        f"""CASE WHEN c_custkey % 109 = 6 THEN NULL ELSE {_created("c_custkey")} END
            AS record_created_ts""",
        f"""CAST({_TODAY} - CAST(c_custkey % 5 AS INT) AS TIMESTAMP_NTZ)
            AS record_updated_ts""",
    )


class SampleTables:
    """The four tables, each read when it is first used."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._read = lambda name: star_table(spark, sf_dir, name)

    @cached_property
    def _customer(self) -> DataFrame:
        return self._read("customer")

    @cached_property
    def spine(self) -> DataFrame:
        return person_spine(self._customer)

    @cached_property
    def xref(self) -> DataFrame:
        return person_identifier_xref(self._read("orders"))

    @cached_property
    def behavior(self) -> DataFrame:
        return customer_behavior_daily(self._read("events"))

    @cached_property
    def contact(self) -> DataFrame:
        return person_contact_profile(self._customer)
