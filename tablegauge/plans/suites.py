"""The check suites of the four profiled tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegauge.functions import exact_length, like, min_digits
from tablegauge.operators.checks import (
    DistinctCount,
    RowCount,
    Suite,
    count_where,
    coverage_gap_pct,
    deactivated_pct,
    foreign_key,
    matches,
    measured,
    min_age,
    not_null,
    ordered,
    period_drop_pct,
    required_when,
    unique,
)
from tablegauge.sources import seeds


def person_spine(as_of: date) -> Suite:
    rows, keys = RowCount(), DistinctCount(("person_id",))
    inactive = ~F.col("is_active")
    return Suite(
        table_name=seeds.PERSON_SPINE[0],
        checks=(
            not_null("REQ_PERSON_ID", "person_id"),
            unique("UNQ_PERSON_ID", keys, rows),
            not_null("REQ_IDENTITY_TYPE_USED", "identity_type_used"),
            not_null("REQ_SRC_SYSTEM_CD", "src_system_cd"),
            not_null("REQ_SRC_CUSTOMER_ID", "src_customer_id"),
            not_null("REQ_CREATE_TS", "record_created_ts"),
            ordered("LOG_CREATE_LS_UPDATE_TS", "record_created_ts", "record_updated_ts"),
            not_null("REQ_DECISION_VERSION", "decision_version"),
            ordered("LOG_FIRST_LS_LAST_SEEN", "first_seen_date", "last_seen_date"),
            min_age("LOG_DOB", "date_of_birth", 18, as_of),
            count_where("THR_SSN_NULL", F.col("ssn").isNull()),
            count_where("THR_DOB_NULL", F.col("date_of_birth").isNull()),
            count_where("THR_IS_ACTIVE_FALSE", inactive),
            deactivated_pct(
                "THR_RECORD_DROP_PCT",
                inactive & (F.to_date("record_updated_ts") == F.lit(as_of)),
                rows,
            ),
        ),
        metadata=(measured("TOTAL_VOL", rows), measured("DISTINCT_PERSON_ID", keys)),
    )


def person_identifier_xref(
    as_of: date, spine: DataFrame, *, fk_mode: str = "null_aware", unscoped: bool = False
) -> Suite:
    """Open identifier links.

    Only links without an end date are in scope, so the two checks that look at end dates always
    give 0. `unscoped` evaluates those two over all links and leaves the others as they are.
    """
    still_open = F.col("effective_end_date").isNull()
    scope = still_open if unscoped else None
    rows = RowCount(scope)
    keys = DistinctCount(
        ("src_system_cd", "source_identifier_type", "source_identifier_value", "person_id"), scope
    )
    return Suite(
        table_name=seeds.PERSON_IDENTIFIER_XREF[0],
        scope=None if unscoped else still_open,
        checks=(
            not_null("REQ_PK", *keys.columns, scope=scope),
            unique("UNQ_PK", keys, rows),
            foreign_key(
                "REQ_PERSON_ID_EXISTS", "person_id", spine, "person_id", mode=fk_mode, scope=scope
            ),
            not_null("REQ_CREATE_TS", "record_created_ts", scope=scope),
            ordered(
                "LOG_CREATE_LS_UPDATE_TS", "record_created_ts", "record_updated_ts", scope=scope
            ),
            ordered("LOG_EFFECTIVE_START_LS_END_TS", "effective_start_date", "effective_end_date"),
            deactivated_pct(
                "THR_RECORD_DROP_PCT",
                F.to_date("effective_end_date") == F.lit(as_of),
                RowCount() if unscoped else rows,
            ),
        ),
        metadata=(measured("TOTAL_VOL", rows), measured("DISTINCT_PK", keys)),
        emit_metadata=True,
    )


def customer_behavior_daily(
    as_of: date, spine: DataFrame, *, fk_mode: str = "null_aware"
) -> Suite:
    rows, keys = RowCount(), DistinctCount(("person_id", "business_date"))
    return Suite(
        table_name=seeds.CUSTOMER_BEHAVIOR_DAILY[0],
        checks=(
            not_null("REQ_PK", *keys.columns),
            unique("UNQ_PK", keys, rows),
            foreign_key("REQ_PERSON_ID_EXISTS", "person_id", spine, "person_id", mode=fk_mode),
            not_null("REQ_SRC_SYSTEM_CD", "src_system_cd"),
            not_null("REQ_IS_ACTIVE_FLAG", "is_active_customer_flag"),
            required_when(
                "DEP_INACTIVE_REQUIRES_DAYS",
                ~F.col("is_active_customer_flag") & F.col("last_activity_date").isNotNull(),
                "days_since_inactive",
            ),
            ordered("LOG_CREATE_LS_UPDATE_TS", "record_created_ts", "record_updated_ts"),
            count_where("THR_SSN_NULL", F.col("ssn").isNull()),
            period_drop_pct("THR_RECORD_DROP_PCT", "business_date", as_of),
        ),
        metadata=(measured("TOTAL_VOL", rows), measured("DISTINCT_PK", keys)),
        emit_metadata=True,
    )


def person_contact_profile(
    as_of: date, spine: DataFrame, *, fk_mode: str = "null_aware"
) -> Suite:
    """Contact data of active persons.

    Coverage, drop and name checks look at all rows, though their denominator counts active keys
    only. The key is one text, so two different pairs may share it.
    """
    active = F.col("is_active")
    rows = RowCount(active)
    keys = DistinctCount((F.concat("person_id", F.lit("-"), "src_system_cd"),), active)
    return Suite(
        table_name=seeds.PERSON_CONTACT_PROFILE[0],
        checks=(
            not_null("REQ_PK", "person_id", "src_system_cd", active, scope=active),
            unique("UNQ_PK", keys, rows),
            foreign_key(
                "REQ_PERSON_ID_EXISTS", "person_id", spine, "person_id", mode=fk_mode, scope=active
            ),
            not_null("REQ_RECORD_CREATED_TS", "record_created_ts", scope=active),
            ordered(
                "LOG_RECORD_CREATED_LS_UPDATED",
                "record_created_ts",
                "record_updated_ts",
                scope=active,
            ),
            matches(
                "VAL_EMAIL_FORMAT",
                "primary_email_address",
                like("%@%"),
                guard=F.col("primary_email_valid_flag") == 1,
                scope=active,
            ),
            matches(
                "VAL_PHONE_FORMAT",
                "primary_phone_number",
                min_digits(10),
                guard=F.col("primary_phone_valid_flag") == 1,
                scope=active,
            ),
            matches("VAL_STATE_CODE", "mailing_address_state_cd", exact_length(2), scope=active),
            coverage_gap_pct(
                "THR_EMAIL_COVERAGE_DROP",
                "primary_email_address",
                "record_updated_ts",
                as_of,
                keys,
            ),
            coverage_gap_pct(
                "THR_PHONE_COVERAGE_DROP", "primary_phone_number", "record_updated_ts", as_of, keys
            ),
            coverage_gap_pct(
                "THR_ADDRESS_COVERAGE_DROP",
                "mailing_address_line1",
                "record_updated_ts",
                as_of,
                keys,
            ),
            deactivated_pct(
                "THR_RECORD_DROP_PCT",
                ~active & (F.to_date("record_updated_ts") == F.lit(as_of)),
                keys,
            ),
            not_null("THR_NAME_NULL", "first_name", "last_name"),
        ),
        metadata=(measured("TOTAL_VOL", rows), measured("DISTINCT_PK", keys)),
    )
