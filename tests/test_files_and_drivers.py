import json

import pytest

from strataforge.plans.drivers import TRANSFORMS, run_ingestion, run_staging, run_transform
from strataforge.sinks.writers import AuditLog, VersionedTable, write_target
from strataforge.sources import delimited, external
from strataforge.sources.metadata import Catalog, load_contract, validate_metadata
from strataforge.sources.model_export import FILES, load_export, profile_file, validate_export

HEAD = "client_id,client_name,effective_at,updated_at"
NOW = "2025-01-02T03:04:05+00:00"
CONFIG = {"source_system_id": "SRC", "table_config": {"clients.csv": {"dataset_id": "DS_C", "primary_key": "client_id", "dataset_group": "g"}}}


@pytest.fixture
def root(tmp_path):
    (tmp_path / "metadata.json").write_text(json.dumps({"tables": {"clients.csv": {"columns": HEAD.split(",")}}}))
    return tmp_path


def put(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


def stage(spark, root, **kw):
    return run_staging(spark, str(root), str(root / "out"), CONFIG, run_id="R", batch_date="2025-01-02", now=NOW, **kw)[0]


def test_full_run_parts_quotes_and_audit(spark, root):
    put(root / "clients.csv", HEAD, '1,"Two\nlines, and ""quotes""",2025-01-01,2025-01-01', "2,b,2025-01-01,2025-01-01")
    put(root / "clients_2.csv", HEAD, "2,b,2025-01-01,2025-01-01", "3,x,2025-01-01,2025-01-01", "3,y,2025-01-01,2025-01-01")
    put(root / "other.csv", HEAD)
    e = stage(spark, root)
    assert (e["status"], e["source_file_count"], e["source_record_count"], e["exact_duplicate_count"], e["ambiguous_latest_count"]) == ("SUCCESS_WITH_WARNINGS", 2, 5, 1, 2)
    staged = spark.read.parquet(e["staging_path"])
    assert sorted(r._source_row_number for r in staged.where("_source_file_name = 'clients.csv'").collect()) == ["2", "3"]
    assert 'Two\nlines, and "quotes"' in [r.client_name for r in staged.collect()]
    assert spark.read.parquet(e["rejected_path"]).count() == 2
    assert all(open(p.removeprefix("file:")).read() for p in e["raw_paths"])
    assert AuditLog(spark, str(root / "out/audit")).read().count() == 1


def test_delta_manifest(spark, root):
    put(root / "delta_sources/2025-01-02/manifest.csv", "source_date,table_name,row_count,delta_type", "2025-01-02,clients.csv,1,delta", "2025-01-02,unknown.csv,9,delta")
    put(root / "delta_sources/2025-01-02/clients.csv", HEAD + ",delta_action", "1,a,2025-01-01,2025-01-01,DELETE")
    e = stage(spark, root, load_type="delta", source_date="2025-01-02")
    assert e["status"] == "SUCCESS" and spark.read.parquet(e["staging_path"]).first()["_delta_action"] == "DELETE"
    put(root / "delta_sources/2025-01-03/manifest.csv", "source_date,table_name,row_count", "2025-01-04,clients.csv,1")
    with pytest.raises(ValueError, match="dates clients.csv to 2025-01-04"):
        stage(spark, root, load_type="delta", source_date="2025-01-03")


def test_wrong_counts_headers_and_missing_times_are_audited(spark, root):
    put(root / "full_sources/2025-01-02/manifest.csv", "source_date,table_name,row_count", "2025-01-02,clients.csv,5")
    put(root / "full_sources/2025-01-02/clients.csv", HEAD, "1,a,2025-01-01,2025-01-01")
    assert "announces 5 rows of clients.csv, its files hold 1" in stage(spark, root, source_date="2025-01-02")["error_message"]
    put(root / "clients.csv", "client_id,wrong", "1,a")
    assert "has the columns" in stage(spark, root)["error_message"]
    put(root / "clients.csv", HEAD, "1,a,,2025-01-01")
    assert "clients.csv: row 2 lacks effective_at or updated_at" in stage(spark, root)["error_message"]
    put(root / "full_sources/2025-01-09/manifest.csv", "source_date,table_name,row_count")
    put(root / "delta_sources/2025-01-07/manifest.csv", "source_date,table_name,row_count", "2025-01-07,clients.csv,1")
    put(root / "delta_sources/2025-01-07/clients.csv", HEAD, "1,a,2025-01-01,2025-01-01")
    assert "and delta_action" in stage(spark, root, load_type="delta", source_date="2025-01-07")["error_message"]
    with pytest.raises(ValueError, match="doesn't list"):
        stage(spark, root, source_date="2025-01-09")
    with pytest.raises(ValueError, match="Unsupported load_type"):
        stage(spark, root, load_type="weekly")
    with pytest.raises(FileNotFoundError):
        stage(spark, root, load_type="delta", source_date="2030-01-01")


def test_backfill(spark, root):
    put(root / "old_datasets/clients.csv", HEAD, "1,a,2025-01-01,2025-01-01")
    assert stage(spark, root)["source_record_count"] == 1


def test_ingestion_and_metadata(spark, tmp_path):
    put(tmp_path / "in/p.tsv", "a\tb", "1\t2", "3\t4")
    meta = {
        "metadata_version": "1",
        "datasets": [{"dataset_id": "A", "dataset_name": "a", "source_system_id": "s", "load_type": "full", "active_flag": True, "dataset_group": "g"}, {"dataset_id": "B", "active_flag": False}, {"dataset_id": "C", "active_flag": True}],
        "dataset_sources": [{"dataset_id": "A", "source_object_type": "file", "source_path": "/in/p.tsv", "source_format": "csv", "source_delimiter": "tab", "active_flag": True}, {"dataset_id": "C", "active_flag": True}],
        "dataset_targets": [{"dataset_id": "A", "target_platform": "file", "target_path": "/land/p.tsv", "write_mode": "overwrite", "active_flag": True}, {"dataset_id": "C", "active_flag": True}],
    }
    c = Catalog(spark, metadata=meta)
    events = run_ingestion(spark, c, str(tmp_path), str(tmp_path / "audit"), run_id="R", now=NOW)
    assert [(e["dataset_id"], e["status"]) for e in events] == [("A", "SUCCESS"), ("C", "FAILED")]
    assert events[0]["target_record_count"] == 2 and "The dataset record has no dataset_name, source_system_id, load_type" in events[1]["error_message"]
    assert [d["dataset_id"] for d in c.active_datasets(dataset_group="g")] == ["A"]
    assert c.frame("md_dataset", "datasets").count() == 3
    with pytest.raises(KeyError):
        c.source("B")
    assert "The source record belongs to B, not to A" in validate_metadata({"dataset_id": "A"}, {"dataset_id": "B"}, {"dataset_id": "A"})


def test_transform_run(spark, tmp_path):
    put(tmp_path / "raw/p.tsv", "indic_de_geo_time\t2019", "PC_Y0_14,AU\t18.7p", "PC_Y0_14,ZZZ\t1")
    put(tmp_path / "lookup/c.csv", "country,country_code_2_digit,country_code_3_digit,population", "Australia,AU,AUS,25")
    contract = {"dataset_id": "DS_REF_POPULATION_001", "inputs": [{"path": "/raw/p.tsv", "delimiter": "tab"}], "lookups": [{"path": "/lookup/c.csv", "delimiter": "comma"}], "target": {"platform": "file", "format": "csv", "path": "/out/p"}, "expected_columns": ["country", "age_group_0_14"]}
    (tmp_path / "c.json").write_text(json.dumps(contract))
    run = lambda key: run_transform(spark, str(tmp_path / "c.json"), str(tmp_path), str(tmp_path / "audit"), dataset_id=key, run_id="R", now=NOW)
    e = run("DS_REF_POPULATION_001")
    assert (e["status"], e["input_record_count"], e["output_record_count"]) == ("SUCCESS", 2, 1)
    assert float(spark.read.option("header", True).csv(str(tmp_path / "out/p")).first()["age_group_0_14"]) == 18.7
    with pytest.raises(ValueError, match="Contract is for"):
        run("OTHER")
    put(tmp_path / "raw/p.tsv", "indic_de_geo_time\t2019", "PC_Y0_14,AU\t1.2.3")
    assert "is no percentage" in run("DS_REF_POPULATION_001")["error_message"]
    with pytest.raises(ValueError, match="is no JSON contract"):
        load_contract(spark, str(tmp_path / "c.yaml"))
    assert "DS_REF_POPULATION_001" in TRANSFORMS


def test_model_export(spark, tmp_path):
    assert validate_export(spark, str(tmp_path)) == [f"{f} is not there" for f in FILES]
    values = {"erwin_model.csv": ["m,1,s,t,me"], "erwin_objects.csv": ["m,1,s,E,O,table,p,d"], "erwin_columns.csv": ["m,1,O,l,C,string,,,,Y,N,b,d,public", "m,1,O,l,D,,,,,Y,N,b,d,odd"], "erwin_mappings.csv": ["m,1,s,o,c,t,o,,x,b,public"]}
    for f, rows in values.items():
        put(tmp_path / f, ",".join(FILES[f]), *rows)
    out = load_export(spark, str(tmp_path), model_version_id="V", imported_at=NOW)
    assert out.errors == [] and out.report["column_count"] == 2 and out.report["warning_count"] == 3
    assert out.tables["stg_erwin_column"].first()["erwin_model_version"] == "1"
    put(tmp_path / "erwin_columns.csv", ",".join(FILES["erwin_columns.csv"]), values["erwin_columns.csv"][0], values["erwin_columns.csv"][0], "m,1,,l,C,string,,,,Y,N,b,d,public")
    put(tmp_path / "erwin_model.csv", ",".join(FILES["erwin_model.csv"]), "m,,s,t,me")
    out = load_export(spark, str(tmp_path), model_version_id="V", imported_at=NOW)
    assert out.report["import_status"] == "FAILED" and out.errors == [
        "erwin_model.csv:2 has no model_version", "erwin_columns.csv:3 repeats O.C", "erwin_columns.csv:4 has no physical_object_name",
    ]


def test_profile_file(spark, tmp_path):
    put(tmp_path / "p.tsv", "a\tb\tc", "1\t2.5\tx", "2\t\ty")
    out = profile_file(spark, str(tmp_path), "D", "/p.tsv")
    assert [c["data_type"] for c in out["columns"]] == ["integer", "decimal", "string"] and out["profile"]["sample_row_count"] == 2
    (tmp_path / "empty.tsv").write_text("")
    assert profile_file(spark, str(tmp_path), "D", "empty.tsv")["report"]["warning_count"] == 1
    with pytest.raises(FileNotFoundError):
        profile_file(spark, str(tmp_path), "D", "none.tsv")


def test_targets_tables_and_catalog(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "i int, s string")
    with pytest.raises(ValueError, match="Unsupported target platform"):
        write_target(df, {"platform": "paper", "path": "x"})
    for mode, n in (("overwrite", 2), ("append", 4), ("overwrite", 2)):
        path = write_target(df, {"platform": "delta", "path": "t", "write_mode": mode}, str(tmp_path))
        assert spark.read.parquet(path).count() == n
    t = VersionedTable(spark, str(tmp_path / "v"))
    assert not t.exists()
    for i in range(4):
        t.replace(df.limit(i), f"b{i}")
    t.replace(df, "b1")
    assert t.read().count() == 2 and t.has_batch("b1")
    t.vacuum()
    assert t.read().count() == 2 and sum(p.name.startswith("p-") for p in (tmp_path / "v").iterdir()) == 2
    assert external.list_files(spark, str(tmp_path / "t"), "*.parquet").count() > 0
    external.create_external_table(spark, "ext_t", str(tmp_path / "t"))
    external.refresh_table(spark, "ext_t")
    assert external.catalog_columns(spark).where("object_name = 'ext_t'").count() == 2
    spark.sql("drop table ext_t")
    typed = external.typed(spark.createDataFrame([("1.6", "x", "2025-01-01")], "n string, gross_amount string, a_date string"), {"n": "int"}).first()
    assert typed.n == 2 and typed.gross_amount is None and str(typed.a_date) == "2025-01-01"
    lost = external.failed_casts(spark.createDataFrame([("1", "2025-01-01"), ("x", "2025-01-01"), (None, "never")], "n string, a_date string"), {"n": "int"}).collect()
    assert [(r.n, r.a_date, r._failed_columns) for r in lost] == [("x", "2025-01-01", "n"), (None, "never", "a_date")]
    assert delimited.count_rows(spark, str(_csv(tmp_path))) == 1


def _csv(tmp_path):
    put(tmp_path / "one.csv", "a,b", '"x\ny",2')
    return tmp_path / "one.csv"


def test_jdbc_target_and_partitioned_source(spark):
    """Against the embedded database that Spark ships with."""
    url, driver = "jdbc:derby:memory:strataforge;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    df = spark.range(100).selectExpr("cast(id as int) as i", "cast(id * 2 as int) as j")
    target = {"platform": "jdbc", "object": "t_numbers", "write_mode": "overwrite", "options": {"url": url, "driver": driver}}
    assert write_target(df, target) == "t_numbers"
    back = external.read_jdbc(spark, url, "t_numbers", partition_column="i", lower=0, upper=100, partitions=4, properties={"driver": driver})
    assert back.rdd.getNumPartitions() == 4 and back.selectExpr("sum(j)").first()[0] == 9900
    assert external.read_incremental(back, "i", 89, "j < 190").count() == 5


def test_source_by_metadata(spark, tmp_path):
    put(tmp_path / "a.psv", "x|y", "1|2")
    rows = external.read_source(spark, {"source_format": "csv", "source_path": "/a.psv", "source_delimiter": "pipe"}, str(tmp_path))
    assert [tuple(r) for r in rows.collect()] == [("1", "2")]
    rows.write.parquet(str(tmp_path / "p"))
    assert external.read_source(spark, {"source_format": "parquet", "source_path": "/p"}, str(tmp_path)).count() == 1
