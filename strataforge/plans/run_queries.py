"""Queries of sources, sinks and runs: files are written from the driver's tables, the run goes over them, and what it leaves is
compared with SQL on the tables themselves."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataforge.functions.values import ts_text
from strataforge.operators import conform, quality
from strataforge.plans import sqltext
from strataforge.plans.drivers import build_feature, run_conform, run_governance, run_ingestion, run_staging, run_transform
from strataforge.plans.problems import transactions
from strataforge.plans.queries import QUERIES, SQL, _batch, query, scratch
from strataforge.session import table
from strataforge.sinks.writers import AuditLog, VersionedTable, empty_clone, reload_table, save_as_table, write_evidence, write_target
from strataforge.sources import delimited, external, model_export
from strataforge.sources.delimited import Files
from strataforge.sources.metadata import Catalog

NOW = "2024-02-01T06:00:00Z"


def put_csv(df: DataFrame, path: str, sep: str = ",") -> str:
    """df as one delimited file of that name."""
    aside = f"{path}.parts"
    df.coalesce(1).write.option("header", True).option("sep", sep).option("escape", '"').option("quoteAll", False).csv(aside)
    files = Files(df.sparkSession)
    files.copy(next(p for p in files.list(aside) if p.endswith(".csv")), path)
    files.delete(aside)
    return path


def put_json(spark: SparkSession, path: str, content) -> str:
    Files(spark).write_text(path, json.dumps(content))
    return path


_CUSTOMERS = ["c_custkey", "c_name", "effective_at", "updated_at"]


def _customer_files(spark, d, root: str, folder: str, action: bool = False, wanted: str = "true") -> None:
    """Customers in three files, every fifth name with a quote and a line break, every eleventh customer delivered twice."""
    c = table(spark, d, "customer").where(wanted)
    name = F.when(F.col("c_custkey") % 5 == 0, F.concat("c_name", F.lit(', "x"\ny'))).otherwise(F.col("c_name"))
    rows = c.unionByName(c.where("c_custkey % 11 = 0")).select(F.col("c_custkey").alias("k"), F.col("c_custkey").cast("string").alias("c_custkey"), name.alias("c_name"), F.lit("2024-01-01").alias("effective_at"), F.lit("2024-01-02").alias("updated_at"))
    if action:
        rows = rows.withColumn("delta_action", F.when(F.col("k") % 2 == 0, "DELETE").otherwise("UPSERT"))
    for i in range(3):
        put_csv(rows.where(F.col("k") % 3 == i).orderBy("k").drop("k"), f"{root}/{folder}customers_{i}.csv")


def _staging_root(spark, d, name: str) -> tuple[str, dict]:
    root = scratch(spark, name)
    put_json(spark, f"{root}/metadata.json", {"tables": {"customers.csv": {"columns": _CUSTOMERS}, "nations.csv": {"columns": ["n_nationkey", "n_name"]}}})
    config = {
        "source_system_id": "SRC", "table_config": {
            "customers.csv": {"dataset_id": "DS_C", "primary_key": "c_custkey", "dataset_group": "people"},
            "nations.csv": {"dataset_id": "DS_N", "primary_key": "n_nationkey", "source_record_pattern": "append_only_event", "dataset_group": "places"},
        },
    }
    return root, config


_NAME = "case when c_custkey % 5 = 0 then c_name || ', \"x\"' || chr(10) || 'y' else c_name end"
_DELIVERED = "(select c_custkey, c_name from customer union all select c_custkey, c_name from customer where c_custkey % 11 = 0)"


@query(f"with x as (select c_custkey, {_NAME} c_name, 1 + row_number() over (partition by c_custkey % 3 order by c_custkey) r from {_DELIVERED}) "
       "select c_custkey::varchar c_custkey, c_name, 'customers_' || (c_custkey % 3) || '.csv' source_file, r source_row, r > min(r) over (partition by c_custkey) is_duplicate, r = min(r) over (partition by c_custkey) is_latest, '2024-02-01' batch_date from x")  # fmt: skip
def staging_run(spark, d):
    """Three files of one table to staging: parts found, header checked, rows numbered, duplicates and latest rows marked."""
    root, config = _staging_root(spark, d, "staging")
    _customer_files(spark, d, root, "")
    put_csv(table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("n_nationkey"), "n_name"), f"{root}/old_datasets/nations.csv")
    out = f"{root}/out"
    done = run_staging(spark, root, out, config, run_id="R1", batch_date="2024-02-01", now=NOW)
    again = run_staging(spark, root, out, config, run_id="R2", batch_date="2024-02-01", now=NOW, dataset_group="people")  # the partition is replaced, not added to
    assert [e["status"] for e in done + again] == ["SUCCESS"] * 3, [e.get("error_message") for e in done + again]
    s = spark.read.parquet(again[0]["staging_path"])
    return s.select("c_custkey", "c_name", F.col("_source_file_name").alias("source_file"), F.col("_source_row_number").cast("long").alias("source_row"), F.col("_is_exact_duplicate").alias("is_duplicate"), F.col("_is_latest_for_business_key").alias("is_latest"), F.col("batch_date").cast("string").alias("batch_date"))


@query(f"select 'DS_C' dataset_id, 'SUCCESS' status, count(*) source_record_count, count(*) filter (c_custkey % 2 = 0) deletes, 3::bigint raw_files from {_DELIVERED} where c_custkey < 100 union all select 'DS_N', 'FAILED', 0, 0, 0")
def staging_delta_run(spark, d):
    """A delta by its manifest: one table as announced, of the other two rows more are announced than there are."""
    root, config = _staging_root(spark, d, "delta")
    _customer_files(spark, d, root, "delta_sources/2024-02-01/", True, "c_custkey < 100")
    n = table(spark, d, "nation")
    put_csv(n.select(F.col("n_nationkey").cast("string").alias("n_nationkey"), "n_name", F.lit("UPSERT").alias("delta_action")), f"{root}/delta_sources/2024-02-01/nations.csv")
    some = table(spark, d, "customer").where("c_custkey < 100")
    announced = [("2024-02-01", "customers.csv", some.count() + some.where("c_custkey % 11 = 0").count()), ("2024-02-01", "nations.csv", n.count() + 2)]
    put_csv(spark.createDataFrame(announced, "source_date string, table_name string, row_count long"), f"{root}/delta_sources/2024-02-01/manifest.csv")
    run_staging(spark, root, f"{root}/out", config, run_id="R1", batch_date="2024-02-01", now=NOW, load_type="delta", source_date="2024-02-01")
    audit = AuditLog(spark, f"{root}/out/audit").read()
    staged = spark.read.parquet(f"{root}/out/staging/domain=fleet_management/dataset=customers")
    raw = external.list_files(spark, f"{root}/out/raw/source_system=SRC/dataset=customers", "*.csv")
    deletes = F.when(F.col("dataset_id") == "DS_C", staged.where("_delta_action = 'DELETE'").agg(F.count(F.lit(1))).scalar()).otherwise(0)
    files = F.when(F.col("dataset_id") == "DS_C", raw.agg(F.count(F.lit(1))).scalar()).otherwise(0)
    return audit.select("dataset_id", "status", "source_record_count", deletes.alias("deletes"), files.alias("raw_files"))


@query("select 'D1' dataset_id, 'SUCCESS' status, (select count(*) from nation) target_record_count, 'v7' metadata_version, 'dim' dataset_group union all select 'D2', 'FAILED', null, 'v7', 'dim' union all select 'D3', 'FAILED', null, 'v7', 'dim'")
def ingestion_run(spark, d):
    """Datasets of a metadata file to landing: one lands, one lacks a required field, one's file isn't there; an inactive one is left out."""
    root = scratch(spark, "ingestion")
    put_csv(table(spark, d, "nation"), f"{root}/in/nation.tsv", "\t")
    dataset = lambda i, **more: {"dataset_id": f"D{i}", "dataset_name": f"n{i}", "source_system_id": "s", "load_type": "full", "active_flag": True, "dataset_group": "dim", **more}
    source = lambda i, path: {"dataset_id": f"D{i}", "source_object_type": "file", "source_path": path, "source_format": "csv", "source_delimiter": "tab", "active_flag": True}
    target = lambda i: {"dataset_id": f"D{i}", "target_platform": "file", "target_path": f"/land/{i}.tsv", "write_mode": "overwrite", "active_flag": True}
    meta = {
        "metadata_version": "v7", "datasets": [dataset(1), dataset(2, dataset_name=""), dataset(3), dataset(4, active_flag=False)],
        "dataset_sources": [source(1, "/in/nation.tsv"), source(2, "/in/nation.tsv"), source(3, "/in/none.tsv")], "dataset_targets": [target(i) for i in (1, 2, 3)],
    }
    catalog = Catalog(spark, put_json(spark, f"{root}/meta.json", meta))
    run_ingestion(spark, catalog, root, f"{root}/audit", run_id="R", now=NOW)
    groups = catalog.frame("md_dataset", "datasets").select("dataset_id", "dataset_group")
    return AuditLog(spark, f"{root}/audit").read().join(groups, "dataset_id").select("dataset_id", "status", "target_record_count", "metadata_version", "dataset_group")


_GROUPS = ["PC_Y0_14", "PC_Y15_24", "Y25_49", "PC_Y50_64", "PC_Y65_79", "PC_Y80_MAX"]
_POP = f"""with p as (
  select n_nationkey k, c_custkey pos, c_custkey % 6 g, case when c_custkey % 13 = 0 then null else round(abs(c_acctbal), 1) end v from customer join nation on n_nationkey = c_nationkey where c_custkey % 7 <> 0
)
select n_name country, chr((65 + n_nationkey)::int) || 'Z' country_code_2_digit, chr((65 + n_nationkey)::int) || 'ZZ' country_code_3_digit, n_nationkey::varchar population,
{', '.join(f"max_by(v, pos) filter (g = {i} and v is not null and pos = m{i}) {c}" for i, c in enumerate(['age_group_0_14', 'age_group_15_24', 'age_group_25_49', 'age_group_50_64', 'age_group_65_79', 'age_group_80_max']))}
from (select *, {', '.join(f"max(pos) filter (g = {i}) over (partition by k) m{i}" for i in range(6))} from p) join nation on n_nationkey = k group by n_name, n_nationkey"""


def _population(spark, d) -> tuple[DataFrame, DataFrame]:
    """Customers as percentages of countries by age group, in the source's form: some with a letter behind, some missing, some of unknown countries, repeated groups."""
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    group = F.element_at(F.array(*[F.lit(g) for g in _GROUPS]), (F.col("c_custkey") % 6 + 1).cast("int"))
    code = F.when(F.col("c_custkey") % 7 == 0, "XXX").otherwise(F.concat(F.char(F.col("n_nationkey") + 65), F.when(F.col("c_custkey") % 2 == 0, "z").otherwise("Z")))
    value = F.when(F.col("c_custkey") % 13 == 0, ":").otherwise(F.concat(F.round(F.abs("c_acctbal"), 1).cast("decimal(9,1)").cast("string"), F.when(F.col("c_custkey") % 3 == 0, "p").otherwise(" ")))
    population = c.select(F.concat(group, F.lit(","), code).alias("indic_de_geo_time"), value.alias("2019"), F.col("c_custkey").alias("pos"))
    two = F.concat(F.char(F.col("n_nationkey") + 65), F.lit("Z"))
    return population, table(spark, d, "nation").select(F.col("n_name").alias("country"), two.alias("country_code_2_digit"), F.concat(two, F.lit("Z")).alias("country_code_3_digit"), F.col("n_nationkey").cast("string").alias("population"))


@query(_POP)
def population_by_age(spark, d):
    """A contract's transform from its two files to its target, read back."""
    root = scratch(spark, "transform")
    population, countries = _population(spark, d)
    put_csv(population.orderBy("pos").drop("pos"), f"{root}/raw/p.tsv", "\t")
    put_csv(countries, f"{root}/lookup/c.csv")
    contract = {
        "dataset_id": "DS_REF_POPULATION_001", "contract_version": "1", "inputs": [{"path": "/raw/p.tsv", "delimiter": "tab"}], "lookups": [{"path": "/lookup/c.csv"}],
        "target": {"platform": "file", "format": "parquet", "path": "/out/p"}, "expected_columns": ["country", "age_group_0_14"],
    }
    done = run_transform(spark, put_json(spark, f"{root}/contract.json", contract), root, f"{root}/audit", dataset_id="DS_REF_POPULATION_001", now=NOW)
    assert done["status"] == "SUCCESS", done["error_message"]
    out = spark.read.parquet(f"{root}/out/p")
    return out.select(*[F.col(c).cast("double").alias(c) if c.startswith("age") else F.col(c) for c in out.columns])


@query("""with o as (select row_number() over (order by o_custkey, o_orderkey) n, * from orders where o_custkey < 200)
select 'DIM' part, c_custkey::varchar k, row_number() over (order by c_custkey) a, n_nationkey + 100 b from customer join nation on n_nationkey = c_nationkey where c_custkey < 200
union all select 'DIM_HIST', c_custkey::varchar, count(*), 0 from customer where c_custkey < 200 group by c_custkey
union all select 'FACT', o_orderkey::varchar, o_custkey, 0 from o union all select 'DAYS', o_custkey::varchar, count(*), 0 from o group by o_custkey, o_orderdate::date
union all select 'SCD1', n_nationkey::varchar, n_regionkey + 1, 0 from nation union all select 'INCR', o_orderkey::varchar, o_custkey, 0 from o""")
def conform_run(spark, d):
    """A configured run: a parent dimension, a child with the parent's key and its history, events, a daily summary, overwritten and incremental rows; twice, of which the second changes nothing."""
    root = scratch(spark, "conform")
    at = "2024-01-01 00:00:00"
    nation = table(spark, d, "nation").select("n_nationkey", "n_name")
    clients = table(spark, d, "customer").where("c_custkey < 200").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    orders = table(spark, d, "orders").where("o_custkey < 200").select("o_orderkey", "o_custkey", "o_orderdate")
    staged = {
        "clients": _batch(clients, "c_custkey", ["n_nationkey"], at), "nations": _batch(nation, "n_nationkey", ["n_name"], at), "orders": _batch(orders.unionByName(orders), "o_orderkey", ["o_custkey"], at), "days": _batch(orders, "o_orderkey", ["o_custkey"], at),
        "regions": _batch(table(spark, d, "nation").select("n_nationkey", (F.col("n_regionkey") + 1).alias("n_regionkey")), "n_nationkey", ["n_regionkey"], at), "increments": _batch(orders, "o_orderkey", ["o_custkey"], at),
    }
    config = {
        "clients": {"target_table": "DIM", "pattern": "current_and_history", "merge_key": "c_custkey", "attributes": ["n_nationkey"], "parents": {"n_nationkey": ("nations", "n_nationkey", "nation_sk", "nation_sk")}},
        "nations": {"target_table": "NATION", "pattern": "scd2", "merge_key": "n_nationkey", "attributes": ["n_name"], "surrogate_key": "nation_sk"},
        "orders": {"target_table": "FACT", "pattern": "append", "merge_key": "o_orderkey", "attributes": ["o_custkey", "o_orderdate"]},
        "days": {"target_table": "DAYS", "pattern": "summary", "merge_key": "o_orderkey", "keys": ["o_custkey"], "event_time": "o_orderdate"},
        "regions": {"target_table": "SCD1", "pattern": "upsert", "merge_key": "n_nationkey", "attributes": ["n_regionkey"]},
        "increments": {"target_table": "INCR", "pattern": "incremental", "merge_key": "o_orderkey", "attributes": ["o_custkey"], "watermark_column": "o_orderkey"},
    }
    for _ in range(2):
        events = run_conform(spark, config, staged, f"{root}/out", f"{root}/audit", run_id="R", batch_id="b1", batch_timestamp="2024-01-01 06:00:00")
        assert {e["status"] for e in events} == {"SUCCESS"}, [e["error_message"] for e in events]
    read = lambda n: VersionedTable(spark, f"{root}/out/{n}").read()
    row = lambda df, part, k, a, b=F.lit(0): df.select(F.lit(part).alias("part"), F.col(k).cast("string").alias("k"), F.col(a).cast("long").alias("a"), b.cast("long").alias("b"))
    # The nations' numbers are 1 to 25 in the order of their keys 0 to 24.
    parts = [
        row(read("DIM"), "DIM", "c_custkey", "sk", F.col("nation_sk") + 99), row(read("DIM_HIST").groupBy("c_custkey").count(), "DIM_HIST", "c_custkey", "count"), row(read("FACT"), "FACT", "o_orderkey", "o_custkey"),
        row(read("DAYS"), "DAYS", "o_custkey", "event_count"), row(read("SCD1"), "SCD1", "n_nationkey", "n_regionkey"), row(read("INCR"), "INCR", "o_orderkey", "o_custkey"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("select r_name physical_object_name, n_name physical_column_name, case when n_nationkey % 3 = 0 then '' else 'string' end data_type, 'M1' model_version_id, 'SUCCESS' import_status, (select count(*) from nation) column_count, (select count(*) from nation where n_nationkey % 3 = 0) warning_count from nation join region on r_regionkey = n_regionkey")
def model_export_load(spark, d):
    """An export with a column for each nation: validated, staged and reported; staging and report are read from where they were written."""
    root = scratch(spark, "export")
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    given = {
        "erwin_model.csv": (spark.range(1), {"model_name": F.lit("m"), "model_version": F.lit("1"), "export_timestamp": F.lit("t")}), "erwin_objects.csv": (n.select("r_name").distinct(), {"physical_object_name": F.col("r_name")}),
        "erwin_columns.csv": (n, {"physical_object_name": F.col("r_name"), "physical_column_name": F.col("n_name"), "data_type": F.when(F.col("n_nationkey") % 3 != 0, "string"), "classification": F.lit("public")}),
        "erwin_mappings.csv": (n, {"target_column_name": F.col("n_name")}),
    }
    for name, (df, values) in given.items():
        put_csv(df.select(*[values.get(c, F.lit("x")).alias(c) for c in model_export.FILES[name]]), f"{root}/{name}")
    export = model_export.load_export(spark, root, model_version_id="M1", imported_at=NOW, output=f"{root}/out")
    assert not export.errors, export.errors
    report = spark.read.option("multiLine", True).json(f"{root}/out/ingestion_report.json").select("import_status", "column_count", "warning_count")
    columns = spark.read.parquet(f"{root}/out/stg_erwin_column").select("physical_object_name", "physical_column_name", "data_type", "model_version_id")
    return columns.join(report, F.lit(True))


@query("select 'file.csv:' || i || ' ' || problem error from (select 1 + row_number() over (order by c_custkey) i, 'repeats O.C' || (c_custkey % 100) problem, row_number() over (partition by c_custkey % 100 order by c_custkey) n from customer) where n > 1")
def model_export_errors(spark, d):
    """Every repeated column of an export is reported with its row."""
    root = scratch(spark, "bad-export")
    c = table(spark, d, "customer").orderBy("c_custkey")
    for name in model_export.FILES:
        values = {"physical_column_name": F.concat(F.lit("C"), F.col("c_custkey") % 100)} if name == "erwin_columns.csv" else {}
        rows = c if name == "erwin_columns.csv" else spark.range(1)
        put_csv(rows.select(*[values.get(x, F.lit("O" if x == "physical_object_name" else "x")).alias(x) for x in model_export.FILES[name]]), f"{root}/{name}")
    errors = model_export.validate_export(spark, root)
    return spark.createDataFrame([(e.replace("erwin_columns", "file"),) for e in errors], "error string")


@query("select unnest(['c_custkey', 'c_name', 'c_acctbal']) column_name, unnest(['integer', 'string', 'decimal']) data_type, unnest([1, 2, 3]) ordinal_position, (select count(*) from customer) sample_row_count, 'SUCCESS' discovery_status")
def file_profile(spark, d):
    """A delimited file's columns with the type of their first value, and its counts, from the written profile."""
    root = scratch(spark, "profile")
    put_csv(table(spark, d, "customer").orderBy("c_custkey").select("c_custkey", "c_name", F.col("c_acctbal").cast("decimal(14,2)").alias("c_acctbal")), f"{root}/c.psv", "|")
    model_export.profile_file(spark, root, "D", "/c.psv", "pipe", output=root)
    found = spark.read.option("multiLine", True).json(f"{root}/discovery.json")
    return found.select(F.explode("columns").alias("c"), "profile.sample_row_count", "report.discovery_status").select("c.column_name", "c.data_type", F.col("c.ordinal_position").cast("int").alias("ordinal_position"), "sample_row_count", "discovery_status")


@query("select a delimiter, n_nationkey::varchar n_nationkey, n_name, (select count(*) from nation) row_count from nation, (select unnest(['comma', 'csv', 'tab', 'tsv', 'pipe']) a)")
def delimiter_aliases(spark, d):
    """Every delimiter by its name, and the parsed count."""
    root, out = scratch(spark, "aliases"), None
    for name, sep in delimited.DELIMITERS.items():
        path = put_csv(table(spark, d, "nation").select("n_nationkey", "n_name"), f"{root}/{name}.csv", sep)
        one = delimited.read_delimited(spark, path, name).select(F.lit(name).alias("delimiter"), "n_nationkey", "n_name", F.lit(delimited.count_rows(spark, path, name)).cast("long").alias("row_count"))
        out = one if out is None else out.unionByName(one)
    return out


@query("select count(*) * 2 rows_after_refresh, 3::bigint columns_listed, 2::bigint files_listed from nation")
def external_table(spark, d):
    """A table over a folder, more files there, the refresh, its columns in the catalog, its files in the listing."""
    root = scratch(spark, "external")
    name = "ext_" + root.rsplit("-", 1)[1]
    n = table(spark, d, "nation").select(F.col("n_name").alias("name"), F.to_date(F.lit("2024-01-01")).alias("on_date"), F.lit("1.5").cast("decimal(38,2)").alias("paid_amount")).coalesce(1)
    n.write.parquet(f"{root}/t")
    spark.sql(sqltext.external_table(name, f"{root}/t", n.columns))
    before = spark.table(name).count()
    n.write.mode("append").parquet(f"{root}/t")
    external.refresh_table(spark, name)
    rows, columns = spark.table(name).count(), external.catalog_columns(spark).where(F.col("object_name") == name).count()
    spark.sql(f"drop table {name}")
    assert before * 2 == rows
    return spark.createDataFrame([(rows, columns, external.list_files(spark, f"{root}/t", "*.parquet").count())], "rows_after_refresh long, columns_listed long, files_listed long")


@query("select n_nationkey, n_name, 'reloaded' step from nation where n_nationkey >= 10 union all select n_nationkey, n_name, 'loaded' from nation")
def table_sinks(spark, d):
    """A load table made as an empty clone, filled, emptied and filled again; the table it comes from by a generated statement."""
    tag = scratch(spark, "x").rsplit("-", 1)[1]
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    save_as_table(n, f"src_{tag}")
    spark.sql(sqltext.load_staging(f"load_{tag}", f"src_{tag}").replace("CREATE OR REPLACE TABLE", "CREATE TABLE") + "")
    empty_clone(n, f"clone_{tag}")
    reload_table(n, f"clone_{tag}")
    reload_table(n.where("n_nationkey >= 10"), f"clone_{tag}")
    out = spark.table(f"clone_{tag}").withColumn("step", F.lit("reloaded")).unionByName(spark.table(f"load_{tag}").withColumn("step", F.lit("loaded")))
    path = scratch(spark, "tables")
    out.write.parquet(path)
    for t in ("src", "load", "clone"):
        spark.sql(f"drop table {t}_{tag}")
    return spark.read.parquet(path)


@query("select 'kept' part, c_custkey, repeat('*', greatest(length(c_name) - 4, 0)) || right(c_name, 4) c_name, c_acctbal from customer where c_acctbal >= 0 union all select 'quarantined', c_custkey, c_name, c_acctbal from customer where c_acctbal < 0")
def governance_run(spark, d):
    """Rules from a seed file: broken rows are quarantined, names masked in those that stay."""
    path = f"{scratch(spark, 'rules')}/rules.yaml"
    Files(spark).write_text(path, "governance_rules:\n  - dataset_id: c\n    rule_name: not_negative\n    severity: high\n    enforcement_action: quarantine\n    rule_expression: c_acctbal >= 0\n  - rule_name: odd\n    rule_expression: c_custkey > 5\n")
    rules = quality.load_rules(Files(spark).read_text(path))
    done = run_governance(table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal"), rules, {"c_name": "partial"})
    part = lambda n: done[n].select(F.lit(n).alias("part"), "c_custkey", "c_name", "c_acctbal")
    return part("kept").unionByName(part("quarantined"))


@query("select 'column ' || o_orderstatus target_column, o_orderstatus source_column, 'R9' pipeline_run_id, 'c1' generated_code_version, 'm1' model_version from orders group by o_orderstatus")
def lineage_rows(spark, d):
    mappings = table(spark, d, "orders").select(F.col("o_orderstatus").alias("source_column"), F.concat(F.lit("column "), "o_orderstatus").alias("target_column")).distinct()
    return quality.lineage(mappings, run_id="R9", code_version="c1", model_version="m1").select("target_column", "source_column", "pipeline_run_id", "generated_code_version", "model_version")


@query("select count(distinct fuel_transaction_id)::bigint rows_written, count(distinct fuel_transaction_id) || ' rows scored' message from feature_fuel_anomaly_score")
def feature_build(spark, d):
    """The feature built into its table, and the message that says so."""
    target = VersionedTable(spark, scratch(spark, "feature"))
    cols = ["fuel_card_id", "vehicle_id", "client_id", "transaction_datetime", "merchant_state", "fuel_product", "litres", "gross_amount", "source_record_hash", "distance_km"]
    txn = transactions(spark, d, *cols)
    usage = txn.select("vehicle_id", F.col("transaction_datetime").alias("event_date"), "distance_km")
    message = build_feature(target, txn.drop("distance_km"), usage, table(spark, d, "dim_fuel_card"), table(spark, d, "dim_vehicle"), table(spark, d, "dim_client"), batch_date="2025-12-31", scored_at="2025-12-31 06:00:00")
    return target.read().agg(F.count(F.lit(1)).alias("rows_written")).withColumn("message", F.lit(message))


@query("select l_orderkey, l_linenumber from lineitem where l_orderkey % 5 = 0")
def sqltext_orphans(spark, d):
    """The generated statement, run."""
    table(spark, d, "lineitem").createOrReplaceTempView("sqltext_child")
    table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 5 != 0).alias("is_current")).createOrReplaceTempView("sqltext_parent")
    return spark.sql(sqltext.orphans("sqltext_child", "sqltext_parent", "l_orderkey", "o_orderkey")).select("l_orderkey", "l_linenumber")


@query("select user_id, strftime(ts, '%Y-%m-%d') event_date, count(*) event_count, '2024-02-01' batch_date from events group by all")
def sqltext_daily_summary(spark, d):
    staged = table(spark, d, "events").select("user_id", "ts", F.lit("2024-02-01").alias("_batch_date"), F.lit(False).alias("_is_exact_duplicate"), F.lit("passed").alias("_dq_status"))
    staged.createOrReplaceTempView("sqltext_events")
    return spark.sql(sqltext.daily_summary("sqltext_events", ["user_id"], "ts"), args={"batch_date": "2024-02-01"}).withColumn("event_date", F.col("event_date").cast("string"))


@query("select vehicle_id, staged_row_id from vehicles_ext where coalesce(_is_latest_for_business_key, false) and _latest_resolution_status = 'resolved' and not coalesce(_is_exact_duplicate, false) and coalesce(_dq_status, 'passed') = 'passed' and coalesce(upper(trim(_delta_action)), 'UPSERT') <> 'DELETE' and client_id in (select client_id from dim_client where is_current)")
def sqltext_eligible_source(spark, d):
    table(spark, d, "vehicles_ext").createOrReplaceTempView("sqltext_vehicles")
    table(spark, d, "dim_client").createOrReplaceTempView("sqltext_clients")
    return spark.sql(sqltext.eligible_source("sqltext_vehicles", {"client_id": ("sqltext_clients", "client_id")})).select("vehicle_id", "staged_row_id")


# Model columns that are parts, platform columns that are parts with another key: types differ, rows are missing on either side.
@query("""with m as (select upper(p_brand) o, upper('C' || p_partkey) c, case when p_size < 25 then 'INT' else 'STRING' end t from part),
p as (select upper(p_brand) o, upper('C' || p_partkey) c, case when p_size < 20 then 'INT' else 'STRING' end t from part where p_partkey % 3 <> 0 and p_brand <> 'Brand#11' union all select 'BRAND#99', 'X1', 'STRING' union all select upper(p_brand), 'NEW' || p_partkey, 'INT' from part where p_partkey % 50 = 1 and p_brand <> 'Brand#11')
select o object_name, c column_name, 'data_type_mismatch' check_type, 'High' severity from m join p using (o, c) where m.t <> p.t
union all select o, c, case when o in (select o from p) then 'column_missing' else 'object_missing' end, case when o in (select o from p) then 'High' else 'Critical' end from m where (o, c) not in (select (o, c) from p)
union all select o, c, case when o in (select o from m) then 'column_extra' else 'object_extra' end, 'Medium' from p where (o, c) not in (select (o, c) from m)""")
def schema_reconcile(spark, d):
    """Parts as model columns against a platform that lacks some, has others and types some differently."""
    part = table(spark, d, "part")
    facts = [F.lit("true").alias("nullable_flag"), F.lit("false").alias("primary_key_flag"), F.lit("").alias("classification"), F.lit("m").alias("mapping"), F.lit("r").alias("rule")]
    inventory = lambda df, limit, name=F.concat(F.lit("c"), F.col("p_partkey")): df.select(F.col("p_brand").alias("object_name"), name.alias("column_name"), F.when(F.col("p_size") < limit, "int").otherwise("string").alias("data_type"), *facts)
    model = inventory(part, 25)
    there = part.where("p_brand <> 'Brand#11'")
    platform = inventory(there.where("p_partkey % 3 <> 0"), 20).unionByName(inventory(there.where("p_partkey % 50 = 1"), 1000, F.concat(F.lit("new"), F.col("p_partkey"))))
    platform = platform.unionByName(spark.range(1).select(F.lit("Brand#99").alias("object_name"), F.lit("x1").alias("column_name"), F.lit("string").alias("data_type"), *facts))
    return quality.reconcile_schemas(model, model, platform).select("object_name", "column_name", "check_type", "severity")


@query("select o_custkey::varchar dataset_id, count(*) runs, count(*) filter (o_orderstatus = 'F') failed_runs, coalesce(max(o_orderdate) filter (o_orderstatus <> 'F') >= timestamp '1998-01-01' - interval 500 hours, false) fresh from orders group by 1")
def run_monitor(spark, d):
    """Orders as runs of their customer: finished ones failed, others succeeded."""
    runs = table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("dataset_id"), F.when(F.col("o_orderstatus") == "F", "FAILED").otherwise("SUCCESS_WITH_WARNINGS").alias("status"), F.col("o_orderdate").alias("completed_at"))
    return quality.run_monitor(runs, "1998-01-01 00:00:00", 500).select("dataset_id", "runs", "failed_runs", "fresh")


@query("""with t as (select 'T' || p_size test_id, case when min(p_retailprice) > 905 then 'PASS' else 'FAIL' end test_status from part group by p_size)
select 'R' || o_orderkey run_id, o_orderstatus status, (select count(*) from t where test_status = 'FAIL') checks_failed, (select coalesce(string_agg(test_id, ',' order by test_id), '') from t where test_status = 'FAIL') failed_checks,
  (select count(*) filter (test_id in ('T1', 'T2') and test_status <> 'PASS') = 0 and count(*) filter (test_id in ('T1', 'T2')) > 0 from t) certified from orders where o_orderkey = (select min(o_orderkey) from orders)""")
def certification_and_evidence(spark, d):
    """A check for each size of part, a run for each order; the evidence of the first run and whether it may be certified."""
    checks = table(spark, d, "part").groupBy(F.concat(F.lit("T"), "p_size").alias("test_id")).agg(F.when(F.min("p_retailprice") > 905, "PASS").otherwise("FAIL").alias("test_status"))
    audit = table(spark, d, "orders").select(F.concat(F.lit("R"), "o_orderkey").alias("run_id"), F.col("o_orderstatus").alias("status"))
    first = table(spark, d, "orders").agg(F.min("o_orderkey")).first()[0]
    pack = quality.evidence_pack(audit, checks, f"R{first}").select("run_id", "status", "checks_failed", "failed_checks")
    certified = quality.certify(checks, ["T1", "T2"]).select("certified").withColumn("k", F.lit(f"R{first}"))
    return pack.join(certified, F.col("run_id") == F.col("k")).drop("k")


_PROFILED = {"customer": ["c_custkey", "c_name"], "orders": ["o_orderkey", "o_orderstatus", "o_orderpriority"], "documents": ["doc_id", "lang", "source", "n_chars"], "vehicles_ext": ["staged_row_id", "make", "model_year", "vehicle_status"]}


@query(" union all ".join(f"select '{t}' table_name, '{c}' column_name, count(*) \"rows\", count(*) - count({c}) nulls, min({c})::varchar min_value, max({c})::varchar max_value from {t}" for t, cs in _PROFILED.items() for c in cs))
def profile_exact(spark, d):
    """What of a profile is exact: rows, nulls, least and greatest values."""
    out = None
    for t, columns in _PROFILED.items():
        one = quality.profile(table(spark, d, t).select(*columns)).select(F.lit(t).alias("table_name"), "column_name", "rows", "nulls", "min_value", "max_value")
        out = one if out is None else out.unionByName(one)
    return out
