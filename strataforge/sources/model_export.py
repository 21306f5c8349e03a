"""Model exports of four CSV files: validation, typed staging, report. And profiles of delimited files."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataforge.schema import infer_type_by_value
from strataforge.sinks.writers import write_evidence
from strataforge.sources.delimited import DELIMITERS, Files, header, read_delimited

# The files of an export and their columns.
FILES = {
    "erwin_model.csv": [
        "model_name", "model_version", "subject_area", "export_timestamp", "exported_by",
    ],
    "erwin_objects.csv": [
        "model_name", "model_version", "subject_area", "logical_entity_name", "physical_object_name", "object_type", "platform_hint", "description",
    ],
    "erwin_columns.csv": [
        "model_name", "model_version", "physical_object_name", "logical_attribute_name", "physical_column_name", "data_type", "length", "precision", "scale",
        "nullable_flag", "primary_key_flag", "business_definition", "domain_name", "classification",
    ],
    "erwin_mappings.csv": [
        "model_name", "model_version", "source_system_name", "source_object_name", "source_column_name", "target_system_name", "target_object_name",
        "target_column_name", "transformation_text", "business_definition", "classification",
    ],
}
CLASSIFICATIONS = ("public", "internal", "confidential", "restricted", "pii")


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path).withColumn("_row", F.monotonically_increasing_id() + 2)


def validate_export(spark: SparkSession, folder: str) -> list[str]:
    """Missing files and columns, models without name or version, columns without object or name or given twice."""
    files, errors = Files(spark), []
    heads: dict[str, list[str]] = {}
    for name, columns in FILES.items():
        if not files.exists(f"{folder}/{name}"):
            errors.append(f"{name} is not there")
            continue
        heads[name] = header(spark, f"{folder}/{name}")
        errors += [f"{name} has no column {c}" for c in columns if c not in heads[name]]

    def rows(name: str, needed: list[str]) -> DataFrame | None:
        if name not in heads:
            return None
        df = _numbered(spark, f"{folder}/{name}")
        return df.withColumns({c: F.lit("") for c in needed if c not in df.columns})

    found: list[tuple[str, int, str]] = []
    for name, needed in (("erwin_model.csv", ["model_name", "model_version"]), ("erwin_columns.csv", ["physical_object_name", "physical_column_name"])):
        df = rows(name, needed)
        if df is None:
            continue
        problems = [F.when(F.coalesce(F.col(c), F.lit("")) == "", F.lit(f"has no {c}")) for c in needed]
        if name == "erwin_columns.csv":
            again = F.row_number().over(Window.partitionBy(*needed).orderBy("_row")) > 1
            problems.append(F.when(again, F.concat(F.lit("repeats "), F.col(needed[0]), F.lit("."), F.col(needed[1]))))
        listed = df.select("_row", F.array(*problems).alias("_p")).select("_row", F.posexplode("_p").alias("n", "problem")).where("problem is not null")
        found += [(name, r["_row"], r["problem"]) for r in listed.orderBy("_row", "n").collect()]
    return errors + [f"{name}:{row} {problem}" for name, row, problem in found]


def export_warnings(spark: SparkSession, folder: str) -> DataFrame:
    """Softer rules: mappings without target column, columns without type or with an unknown classification."""
    mappings = _numbered(spark, f"{folder}/erwin_mappings.csv").where("coalesce(target_column_name, '') = ''").select(F.lit("erwin_mappings.csv").alias("file_name"), F.col("_row").alias("row_number"), F.lit("target_column_name is empty").alias("warning"))
    columns = _numbered(spark, f"{folder}/erwin_columns.csv")
    untyped = columns.where("coalesce(data_type, '') = ''").select(F.lit("erwin_columns.csv").alias("file_name"), F.col("_row").alias("row_number"), F.lit("data_type is empty").alias("warning"))
    unknown = columns.where(~F.lower("classification").isin("", *CLASSIFICATIONS)).select(F.lit("erwin_columns.csv").alias("file_name"), F.col("_row").alias("row_number"), F.lit("classification is unknown").alias("warning"))
    return mappings.unionByName(untyped).unionByName(unknown)


@dataclass
class ModelExport:
    """A staged export: one frame a file, errors and the report."""

    tables: dict[str, DataFrame]
    errors: list[str]
    report: dict[str, Any]


def load_export(spark: SparkSession, folder: str, *, model_version_id: str, imported_at: str, output: str | None = None) -> ModelExport:
    """Validates, then stages all four files with the model version's id; with errors nothing is staged and the status is FAILED.

    With ``output`` the staged tables are written there as Parquet and the report, with its errors, as JSON.
    """
    errors = validate_export(spark, folder)
    tables: dict[str, DataFrame] = {}
    model: dict[str, str] = {}
    if not errors:
        for name in FILES:
            df = read_delimited(spark, f"{folder}/{name}").withColumnRenamed("model_version", "erwin_model_version")
            df = df.select(F.lit(model_version_id).alias("model_version_id"), "*")
            table = "stg_" + name.removesuffix(".csv").rstrip("s")
            tables[table] = df.withColumns({"import_status": F.lit("SUCCESS"), "imported_at": F.lit(imported_at)}) if name == "erwin_model.csv" else df
        first = tables["stg_erwin_model"].limit(1).collect()
        model = first[0].asDict() if first else {}
    count = lambda t: tables[t].count() if t in tables else 0
    status = "FAILED" if errors else "SUCCESS"
    report = {
        "model_name": model.get("model_name", ""), "model_version": model.get("erwin_model_version", ""), "export_timestamp": model.get("export_timestamp", ""),
        "object_count": count("stg_erwin_object"), "column_count": count("stg_erwin_column"), "mapping_count": count("stg_erwin_mapping"),
        "rejected_row_count": len(errors), "warning_count": 0 if errors else export_warnings(spark, folder).count(), "import_status": status,
    }
    if output is not None:
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{output}/{name}")
        write_evidence(spark, f"{output}/ingestion_report.json", {**report, "errors": errors})
    return ModelExport(tables, errors, report)


def profile_file(spark: SparkSession, root: str, dataset_id: str, relative_path: str, delimiter: str = "tab", run_id: str = "", discovered_at: str = "", output: str | None = None) -> dict[str, Any]:
    """A file's object row, its columns with the type and value of the first row, and counts; a missing file raises. With
    ``output`` all of it is written there as JSON."""
    path = f"{root}/{relative_path.lstrip('/')}"
    files = Files(spark)
    if not files.exists(path):
        raise FileNotFoundError(f"Nothing to profile at {path}")
    size, modified = files.stat(path)
    names = header(spark, path, DELIMITERS.get(delimiter, ","))
    rows = read_delimited(spark, path, delimiter, names) if names else None
    n = rows.count() if rows is not None else 0
    names = names if n else []
    first = rows.limit(1).select(*[F.struct(F.col(f"`{c}`").alias("v"), infer_type_by_value(F.col(f"`{c}`")).alias("t")).alias(f"c{i}") for i, c in enumerate(names)]).collect() if n else []
    columns = [{"object_name": path.rsplit("/", 1)[1], "column_name": c, "data_type": first[0][i]["t"], "nullable_flag": True, "ordinal_position": i + 1, "sample_value": first[0][i]["v"], "discovery_run_id": run_id} for i, c in enumerate(names)]
    found = {
        "object": {"object_name": path.rsplit("/", 1)[1], "object_type": "file", "object_path": relative_path, "discovery_run_id": run_id, "discovered_at": discovered_at},
        "columns": columns,
        "profile": {"dataset_id": dataset_id, "path": relative_path, "delimiter": delimiter, "header_flag": True, "file_count": 1, "total_size_bytes": size, "latest_modified_at": modified, "inferred_column_count": len(names), "sample_row_count": n},
        "report": {"object_count": 1, "column_count": len(names), "file_count": 1, "schema_inferred_flag": bool(names), "discovery_status": "SUCCESS", "warning_count": 0 if n else 1},
    }
    if output is not None:
        write_evidence(spark, f"{output}/discovery.json", found)
    return found
