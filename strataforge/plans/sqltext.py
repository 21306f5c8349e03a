"""Statements for catalogs that know row-level changes, where a warehouse should run a merge instead of this engine.

Each function returns Spark SQL with named parameters (:batch_timestamp, :batch_date). The DataFrame operators in
operators.conform define what they mean; the statements that read only are run against them in the tests.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from strataforge.schema import infer_type_by_name

_PASSED = "coalesce({0}._dq_status, 'passed') = 'passed'"


def _columns(names: Sequence[str], alias: str = "") -> str:
    return ", ".join(f"{alias}.{n}" if alias else n for n in names)


def external_table(name: str, path: str, columns: Sequence[str]) -> str:
    """A table over a Parquet folder, each column typed by its name."""
    typed = ", ".join(f"{c} {infer_type_by_name(c).simpleString()}" for c in columns)
    return f"CREATE TABLE IF NOT EXISTS {name} ({typed}) USING parquet LOCATION '{path}'"


def load_staging(name: str, external: str) -> str:
    return f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM {external}"


def eligible_source(staging: str, parents: Mapping[str, tuple[str, str]] | None = None) -> str:
    """Rows that may be merged; each parent by a semi join, so two current parent rows don't multiply a child."""
    gates = "".join(f" AND EXISTS (SELECT 1 FROM {table} p WHERE p.{key} = s.{child} AND p.is_current)" for child, (table, key) in (parents or {}).items())
    return (
        f"SELECT s.* FROM {staging} s WHERE s._is_latest_for_business_key AND s._latest_resolution_status = 'resolved' AND NOT coalesce(s._is_exact_duplicate, false)"
        f" AND {_PASSED.format('s')} AND coalesce(upper(trim(s._delta_action)), 'UPSERT') <> 'DELETE'{gates}"
    )


def scd2_merge(staging: str, dimension: str, business_key: str, attributes: Sequence[str], parents: Mapping[str, tuple[str, str]] | None = None) -> list[str]:
    """Close changed rows, insert new and changed ones, soft-delete keys a full extract lacks."""
    source, names = eligible_source(staging, parents), [business_key, *attributes]
    target = [*names, "business_key", "effective_from", "effective_to", "is_current", "deleted_flag", "source_effective_at", "source_updated_at", "source_record_hash", "created_at", "updated_at"]
    values = f"{_columns(names, 'n')}, n.{business_key}, n.effective_at, timestamp_ntz '9999-12-31', true, false, n.effective_at, n.updated_at, n._record_hash, :batch_timestamp, :batch_timestamp"
    return [
        f"MERGE INTO {dimension} t USING ({source}) n ON t.{business_key} = n.{business_key} AND t.is_current"
        " WHEN MATCHED AND NOT (t.source_record_hash <=> n._record_hash) THEN UPDATE SET effective_to = coalesce(n.effective_at, :batch_timestamp), is_current = false, updated_at = :batch_timestamp",
        f"INSERT INTO {dimension} ({_columns(target)}) SELECT {values} FROM ({source}) n LEFT ANTI JOIN {dimension} t ON t.{business_key} = n.{business_key} AND t.is_current",
        f"UPDATE {dimension} t SET effective_to = :batch_timestamp, is_current = false, deleted_flag = true, updated_at = :batch_timestamp WHERE t.is_current"
        f" AND EXISTS (SELECT 1 FROM {staging} f WHERE f._load_type = 'full') AND NOT EXISTS (SELECT 1 FROM {staging} s WHERE s.{business_key} = t.{business_key})",
    ]


def append_only_merge(staging: str, fact: str, event_key: str, columns: Sequence[str]) -> str:
    """New events, the first of each key; known ones are left as they are."""
    first = f"SELECT *, row_number() OVER (PARTITION BY {event_key} ORDER BY _source_file_name, cast(_source_row_number AS bigint)) AS _n FROM {staging} s WHERE NOT coalesce(s._is_exact_duplicate, false) AND {_PASSED.format('s')}"
    return (
        f"MERGE INTO {fact} t USING (SELECT * FROM ({first}) WHERE _n = 1) n ON t.event_business_key = n.{event_key} WHEN NOT MATCHED THEN INSERT"
        f" ({_columns(columns)}, event_business_key, batch_date, source_record_hash) VALUES ({_columns(columns, 'n')}, n.{event_key}, n._batch_date, n._record_hash)"
    )


def version_history_merge(staging: str, history: str, business_key: str, columns: Sequence[str]) -> str:
    keys = f"t.event_business_key <=> n.{business_key} AND t.source_updated_at <=> n.updated_at AND t.source_record_hash <=> n._record_hash"
    return (
        f"MERGE INTO {history} t USING (SELECT DISTINCT * FROM {staging}) n ON {keys} WHEN NOT MATCHED THEN INSERT ({_columns(columns)}, event_business_key, source_updated_at,"
        f" source_record_hash, delta_action) VALUES ({_columns(columns, 'n')}, n.{business_key}, n.updated_at, n._record_hash, n._delta_action)"
    )


def orphans(child: str, parent: str, child_key: str, parent_key: str) -> str:
    return f"SELECT c.* FROM {child} c LEFT ANTI JOIN (SELECT {parent_key} FROM {parent} WHERE is_current) p ON c.{child_key} = p.{parent_key} WHERE c.{child_key} IS NOT NULL"


def daily_summary(staging: str, keys: Sequence[str], event_time: str) -> str:
    by = f"{_columns(keys)}, to_date({event_time})"
    return f"SELECT {_columns(keys)}, to_date({event_time}) AS event_date, count(*) AS event_count, :batch_date AS batch_date FROM {staging} s WHERE cast(_batch_date AS string) = :batch_date AND NOT coalesce(_is_exact_duplicate, false) AND {_PASSED.format('s')} GROUP BY {by}"


def rebuild_summary(staging: str, summary: str, keys: Sequence[str], event_time: str) -> list[str]:
    return [f"DELETE FROM {summary} WHERE batch_date = :batch_date", f"INSERT INTO {summary} {daily_summary(staging, keys, event_time)}"]
