"""Targets: files in any format and mode, tables, partitions, versioned tables that swap whole, databases; audit and evidence."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strataforge.sources.delimited import Files
from strataforge.operators.conform import Change
from strataforge.operators.staging import rejects

FILE_PLATFORMS, TABLE_PLATFORMS = ("file", "adls", "onelake"), ("delta", "lakehouse", "databricks")
# What an audit event has unless it says otherwise.
AUDIT_DEFAULTS = {"rejected_record_count": 0, "warning_count": 0, "error_message": ""}


def write_files(df: DataFrame, target: Mapping[str, Any], root: str = "") -> str:
    """Writes in the target's format (csv) and mode (overwrite), partitioned by its partition_columns."""
    path = f"{root.rstrip('/')}/{target['path'].lstrip('/')}" if root else target["path"]
    writer = df.write.format(target.get("format") or "csv").mode(target.get("write_mode") or "overwrite").option("header", True)
    parts = [p.strip() for p in (target.get("partition_columns") or "").split(",") if p.strip()]
    (writer.partitionBy(*parts) if parts else writer).save(path)
    return path


def write_table_format(df: DataFrame, target: Mapping[str, Any], root: str = "") -> str:
    """Delta where its source is on the class path, else Parquet."""
    try:
        df.sparkSession._jvm.java.lang.Class.forName("io.delta.sql.DeltaSparkSessionExtension")
        kind = "delta"
    except Exception:
        kind = "parquet"
    return write_files(df, {**target, "format": kind}, root)


def write_jdbc(df: DataFrame, target: Mapping[str, Any], root: str = "") -> str:
    """A database table; the connection's options are the target's."""
    name = target.get("object") or target["table"]
    df.write.format(target.get("connector") or "jdbc").options(**target.get("options", {})).option("dbtable", name).mode(target.get("write_mode") or "append").save()
    return name


WRITERS = {**dict.fromkeys(FILE_PLATFORMS, write_files), **dict.fromkeys(TABLE_PLATFORMS, write_table_format), **dict.fromkeys(("jdbc", "snowflake", "cosmos"), write_jdbc)}


def write_target(df: DataFrame, target: Mapping[str, Any], root: str = "") -> str:
    platform = (target.get("platform") or target.get("target_platform") or "file").lower()
    if platform not in WRITERS:
        raise ValueError(f"Unsupported target platform: {platform}")
    return WRITERS[platform](df, target, root)


def write_staging(staged: DataFrame, path: str) -> str:
    """Parquet by _batch_date; only the partitions in the batch are replaced."""
    writer = staged.withColumn("batch_date", F.col("_batch_date")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("batch_date").parquet(path)
    return path


def write_rejects(staged: DataFrame, path: str) -> str | None:
    """The ambiguous rows of a run, if there are any."""
    rejected = rejects(staged)
    if rejected.isEmpty():
        return None
    rejected.write.mode("overwrite").parquet(path)
    return path


def drop_partition(spark: SparkSession, path: str, column: str, value: str) -> None:
    """Removes a partition, so that a batch without rows leaves none of the old ones."""
    Files(spark).delete(f"{path}/{column}={value}")


def save_as_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def empty_clone(df: DataFrame, name: str) -> None:
    df.limit(0).write.mode("overwrite").saveAsTable(name)


def reload_table(df: DataFrame, name: str) -> None:
    """A load table emptied and filled again; its definition stays."""
    df.select(*df.sparkSession.table(name).columns).write.insertInto(name, overwrite=True)


def csv_to_parquet(spark: SparkSession, source: str, target: str) -> None:
    """All columns as text, nulls as empty strings."""
    from strataforge.sources.delimited import read_delimited

    read_delimited(spark, source).fillna("").write.mode("overwrite").parquet(target)


class ConcurrentWrite(RuntimeError):
    """Another writer made the next version first; what this one computed is from an old table."""


class Batches:
    """The batch ids a table has, however many: whole numbers as ranges, others by name."""

    def __init__(self, kept: Mapping[str, Any] | None = None) -> None:
        kept = kept or {}
        self.ranges: list[list[int]] = [list(r) for r in kept.get("ranges", [])]
        self.names: list[str] = list(kept.get("names", []))

    @staticmethod
    def _number(batch_id: str) -> int | None:
        return int(batch_id) if batch_id.isascii() and batch_id.isdigit() and str(int(batch_id)) == batch_id else None

    def __contains__(self, batch_id: str) -> bool:
        n = self._number(batch_id)
        return batch_id in self.names if n is None else any(a <= n <= z for a, z in self.ranges)

    def add(self, batch_id: str) -> None:
        n = self._number(batch_id)
        if n is None:
            self.names.append(batch_id)
            return
        merged: list[list[int]] = []
        for a, z in sorted([*self.ranges, [n, n]]):
            if merged and a <= merged[-1][1] + 1:
                merged[-1][1] = max(z, merged[-1][1])
            else:
                merged.append([a, z])
        self.ranges = merged

    def kept(self) -> dict[str, Any]:
        return {"ranges": self.ranges, "names": self.names}


class VersionedTable:
    """A table of immutable folders in named parts; each version is a small numbered file that lists them.

    A batch writes only its own folders: rows added to a part, or a part's rows anew. Readers see the old version or the new,
    never a mixture. A version's file is made only if it isn't there yet, so of two writers one gets ConcurrentWrite (on stores
    whose rename doesn't replace, such as HDFS). All batch ids are kept; a batch that was already written is skipped, so
    repeating it after a failure changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path, self.files = spark, path.rstrip("/"), Files(spark)

    def _versions(self) -> list[str]:
        return [p for p in self.files.list(f"{self.path}/_versions") if p.endswith(".json")]

    def _pointer(self) -> dict[str, Any]:
        """The current version: number, parts (folders by part), schema and batches; number 0 if there is none."""
        found = self._versions()
        return json.loads(self.files.read_text(found[-1])) if found else {"number": 0, "parts": {}}

    def exists(self) -> bool:
        return bool(self._versions())

    def read(self, *parts: str) -> DataFrame:
        """The rows of the parts, by default of all."""
        pointer = self._pointer()
        folders = [f for name, part in pointer["parts"].items() if not parts or name in parts for f in part]
        schema = StructType.fromJson(pointer["schema"])
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders]) if folders else self.spark.createDataFrame([], schema)

    def has_batch(self, batch_id: str) -> bool:
        return batch_id in Batches(self._pointer().get("batches"))

    def replace(self, df: DataFrame, batch_id: str | None = None) -> None:
        """All rows anew: the only part then is ``rows``."""
        self._commit(Change(replaced={"rows": df}), batch_id, keep=False)

    def append(self, df: DataFrame, batch_id: str | None = None) -> None:
        self._commit(Change(added={"rows": df}), batch_id)

    def apply(self, change: Change, batch_id: str | None = None) -> None:
        self._commit(change, batch_id)

    def _commit(self, change: Change, batch_id: str | None, keep: bool = True) -> None:
        was = self._pointer()
        batches = Batches(was.get("batches"))
        if batch_id is not None:
            if batch_id in batches:
                return
            batches.add(batch_id)
        parts = {n: list(f) for n, f in was["parts"].items()} if keep else {}
        schema = was.get("schema")
        for part, df, fresh in [*((n, d, True) for n, d in change.replaced.items()), *((n, d, False) for n, d in change.added.items())]:
            folder = f"p-{uuid.uuid4().hex}"
            df.write.parquet(f"{self.path}/{folder}")
            parts[part] = [folder] if fresh else [*parts.get(part, []), folder]
            schema = json.loads(df.schema.json()) if schema is None or not keep else schema
        pointer = {"number": was["number"] + 1, "parts": parts, "schema": schema, "batches": batches.kept(), "writer": uuid.uuid4().hex}
        if not self.files.create_text(f"{self.path}/_versions/{pointer['number']:012d}.json", json.dumps(pointer)):
            raise ConcurrentWrite(f"Version {pointer['number']} of {self.path} was made by another writer")

    def compact(self) -> None:
        """Each part's folders written as one; the rows are the same."""
        many = [n for n, folders in self._pointer()["parts"].items() if len(folders) > 1]
        if many:
            self._commit(Change(replaced={n: self.read(n) for n in many}), None)

    def vacuum(self) -> None:
        """Deletes what neither the current version nor the one before lists."""
        versions = self._versions()
        keep = {f for v in versions[-2:] for part in json.loads(self.files.read_text(v))["parts"].values() for f in part}
        for v in versions[:-2]:
            self.files.delete(v)
        for p in self.files.list(self.path):
            name = p.rsplit("/", 1)[1]
            if name.startswith("p-") and name not in keep:
                self.files.delete(p)


class AuditLog:
    """Run events as JSON lines, one file a run, so that runs never write the same file."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def log(self, event: Mapping[str, Any], logged_at: str) -> dict[str, Any]:
        full = {"logged_at": logged_at, **AUDIT_DEFAULTS, **event}
        Files(self.spark).write_text(f"{self.path}/event-{uuid.uuid4().hex}.json", json.dumps(full, sort_keys=True) + "\n")
        return full

    def read(self) -> DataFrame | None:
        """All events, or None if there are none yet."""
        files = Files(self.spark)
        return self.spark.read.json(f"{self.path}/event-*.json") if any(p.endswith(".json") for p in files.list(self.path)) else None


def write_evidence(spark: SparkSession, path: str, content: Mapping[str, Any]) -> None:
    Files(spark).write_text(path, json.dumps(content, indent=2, default=str))
