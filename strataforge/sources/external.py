"""Typed scans of Parquet extracts, tables over folders, listings, catalogs and incremental reads."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataforge.schema import infer_type_by_name


def typed(df: DataFrame, types: Mapping[str, str] | None = None) -> DataFrame:
    """Every text column cast to its type, null where it doesn't parse. Types come from the mapping, else from the name.

    Whole-number types round what has a fraction."""
    types = types or {}

    def one(name: str, kind: str):
        want = types.get(name) or infer_type_by_name(name).simpleString()
        c = F.col(f"`{name}`")
        if kind != "string" or want == "string":
            return c
        if want in ("int", "bigint", "integer", "long"):
            return F.round(c.try_cast("decimal(38,6)"), 0).try_cast(want).alias(name)
        return c.try_cast(want).alias(name)

    return df.select(*[one(n, k) for n, k in df.dtypes])


def failed_casts(df: DataFrame, types: Mapping[str, str] | None = None) -> DataFrame:
    """Rows in which a value is there but doesn't parse as its column's type, with _failed_columns: what typed would make null."""
    after = typed(df.withColumn("_raw", F.struct(*[F.col(f"`{c}`") for c in df.columns])), types)
    lost = F.array_compact(F.array(*[F.when(F.col(f"_raw.`{c}`").isNotNull() & F.col(f"`{c}`").isNull(), F.lit(c)) for c in df.columns]))
    return after.withColumn("_failed_columns", F.concat_ws(",", lost)).where("_failed_columns <> ''").select("_raw.*", "_failed_columns")


def typed_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, infer_type_by_name(c)) for c in columns])


def create_external_table(spark: SparkSession, name: str, path: str, columns: list[str] | None = None) -> DataFrame:
    """A catalog table over a Parquet folder; refresh_table after files change."""
    return spark.catalog.createTable(name, path=path, source="parquet", schema=typed_schema(columns) if columns else None)


def refresh_table(spark: SparkSession, name: str) -> None:
    spark.catalog.refreshTable(name)


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, length, modificationTime of the files under a folder; their content isn't read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")


def catalog_columns(spark: SparkSession, database: str | None = None) -> DataFrame:
    """object_name, object_type, column_name, data_type, nullable_flag, ordinal_position of every table of a database."""
    rows = []
    for t in spark.catalog.listTables(database):
        for i, c in enumerate(spark.catalog.listColumns(t.name if not t.namespace else ".".join([*t.namespace, t.name])), 1):
            rows.append((t.name, t.tableType, c.name, c.dataType, c.nullable, i))
    return spark.createDataFrame(rows, "object_name string, object_type string, column_name string, data_type string, nullable_flag boolean, ordinal_position int")


def read_incremental(df: DataFrame, watermark_column: str, last: Any = None, incremental_filter: str | None = None) -> DataFrame:
    """Rows beyond the last watermark that pass the filter; without a watermark all that pass. Rows with null watermark only come
    the first time."""
    out = df if last is None else df.where(F.col(watermark_column) > F.lit(last).cast(dict(df.dtypes)[watermark_column]))
    return out.where(incremental_filter) if incremental_filter else out


def read_jdbc(spark: SparkSession, url: str, table: str, *, partition_column: str | None = None, lower: Any = None, upper: Any = None, partitions: int = 1, properties: Mapping[str, str] | None = None) -> DataFrame:
    """A database table, read in ranges of partition_column where it is given."""
    reader = spark.read.format("jdbc").options(**(properties or {})).option("url", url).option("dbtable", table)
    if partition_column:
        reader = reader.option("partitionColumn", partition_column).option("lowerBound", lower).option("upperBound", upper).option("numPartitions", partitions)
    return reader.load()


def read_source(spark: SparkSession, source: Mapping[str, Any], root: str = "") -> DataFrame:
    """A source by its metadata: file formats by path, jdbc by options; its watermark and filter are the caller's to give."""
    from strataforge.sources.delimited import read_delimited

    kind = source.get("source_format", "csv")
    path = f"{root}{source.get('source_path', '')}"
    if kind in ("csv", "tsv", "text"):
        return read_delimited(spark, path, source.get("source_delimiter", "comma"))
    if kind == "jdbc":
        return read_jdbc(spark, source["source_path"], source["source_object"])
    return spark.read.format(kind).load(path)
