"""Delimited files: scans by contract, row numbers, multi-part discovery, manifests, counts and backfill."""

from __future__ import annotations

import csv
import io
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataforge.operators.staging import DatasetContract
from strataforge.schema import strings
from strataforge.session import materialise

# The names of delimiters.
DELIMITERS = {"comma": ",", "csv": ",", "tab": "\t", "tsv": "\t", "pipe": "|"}


class Files:
    """The few file operations the engine needs, through Hadoop, so that any store works."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.jvm, self.conf = spark, spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def list(self, folder: str) -> list[str]:
        fs, p = self._at(folder)
        if not fs.exists(p):
            return []
        return sorted(s.getPath().toString() for s in fs.listStatus(p))

    def stat(self, path: str) -> tuple[int, int]:
        """Size and modification time in milliseconds."""
        fs, p = self._at(path)
        s = fs.getFileStatus(p)
        return s.getLen(), s.getModificationTime()

    def copy(self, source: str, target: str, overwrite: bool = True) -> str:
        (fs, p), (to_fs, to) = self._at(source), self._at(target)
        to_fs.mkdirs(to.getParent())
        self.jvm.org.apache.hadoop.fs.FileUtil.copy(fs, p, to_fs, to, False, overwrite, self.conf)
        return target

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def read_text(self, path: str) -> str:
        """A small text such as a contract or a pointer."""
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def _aside(self, path: str, text: str):
        """The text in a new file beside path: file context, and both paths."""
        fs, p = self._at(path)
        hadoop = self.jvm.org.apache.hadoop.fs
        aside = hadoop.Path(f"{path}.{uuid.uuid4().hex}.new")
        out = fs.create(aside, True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        return hadoop.FileContext.getFileContext(fs.getUri(), self.conf), fs.makeQualified(aside), fs.makeQualified(p)

    def _renames(self, *names: str):
        options = self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename").getEnumConstants()
        chosen = [next(o for o in options if o.toString() == n) for n in names]
        array = self.spark.sparkContext._gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), len(chosen))
        for i, o in enumerate(chosen):
            array[i] = o
        return array

    def read_head(self, path: str, size: int) -> bytes:
        """A file's first bytes, at most ``size``."""
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return bytes(stream.readNBytes(size))
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """Written aside and renamed over the old one in one step, so a reader, or a run after a crash, sees the old text or the new."""
        context, aside, p = self._aside(path, text)
        context.rename(aside, p, self._renames("OVERWRITE"))

    def create_text(self, path: str, text: str) -> bool:
        """Writes a file that must not be there yet; whether this writer was the one to make it."""
        context, aside, p = self._aside(path, text)
        try:
            context.rename(aside, p, self._renames("NONE"))
        except Exception:
            self.delete(aside.toString())
            if not self.exists(path):
                raise
        return self.read_text(path) == text


def header(spark: SparkSession, path: str, delimiter: str = ",") -> list[str]:
    """The first record, from the file's first bytes; no job runs. An empty file has none."""
    files, size = Files(spark), 1 << 16
    while True:
        head = files.read_head(path, size)
        text = head.decode("utf-8", "ignore").removeprefix("\ufeff")
        reader = csv.reader(io.StringIO(text, newline=""), delimiter=delimiter)
        first = next((row for row in reader if row), [])
        # Whole if something follows it or the file ends with it.
        if len(head) < size or next(reader, None) is not None:
            return first
        size *= 8


def read_delimited(spark: SparkSession, paths: str | Sequence[str], delimiter: str = "comma", columns: list[str] | None = None, multiline: bool = True) -> DataFrame:
    """All columns as text, empty values as empty strings; columns are the header's unless given. Files whose values have no
    line breaks (``multiline`` false) are read in splits."""
    sep = DELIMITERS.get(delimiter, ",")
    first = paths if isinstance(paths, str) else paths[0]
    names = columns or header(spark, first, sep)
    reader = spark.read.schema(strings(names)).option("sep", sep).option("header", True).option("multiLine", multiline).option("escape", '"').option("nullValue", "\u0000").option("emptyValue", "").option("enforceSchema", True)
    return reader.csv(paths if isinstance(paths, str) else list(paths)).fillna("")


def count_rows(spark: SparkSession, path: str, delimiter: str = "comma") -> int:
    """Parsed rows without the header; a missing path raises, an empty file has 0."""
    if not Files(spark).exists(path):
        raise FileNotFoundError(f"There is nothing at {path}")
    rows = spark.read.option("sep", DELIMITERS.get(delimiter, ",")).option("multiLine", True).option("escape", '"').csv(path)
    return max(rows.count() - 1, 0) if rows.columns else 0


def source_files(spark: SparkSession, root: str, table_name: str, load_type: str = "full", source_date: str | None = None) -> list[str]:
    """The table's file and its parts (<stem>_*.csv), sorted, in the root or the dated extract; deltas need a date."""
    if load_type == "delta" and not source_date:
        raise ValueError("A delta load needs a source_date")
    folder = f"{root}/{load_type}_sources/{source_date}" if source_date else root
    stem = table_name.rsplit(".", 1)[0]
    name = lambda p: p.rsplit("/", 1)[1]
    return [p for p in Files(spark).list(folder) if name(p).endswith(".csv") and (name(p) == table_name or name(p).startswith(f"{stem}_"))]


def check_header(actual: list[str], contract: DatasetContract, load_type: str, file_name: str) -> bool:
    """Whether the header has delta_action. Deltas must have it, after the contract's columns; full extracts must be those columns alone."""
    delta = load_type == "delta"
    if actual != [*contract.expected_columns, *["delta_action"] * delta]:
        raise ValueError(f"{file_name} has the columns {actual}, the contract {contract.expected_columns}{' and delta_action' if delta else ''}")
    return delta


def read_source(spark: SparkSession, files: Sequence[str], contract: DatasetContract, load_type: str = "full") -> DataFrame:
    """Rows of all files with _source_file_name, _source_file_path, _source_file_modified_at and _source_row_number (from 2).

    Files with one header are one scan. A first pass counts the rows of every split, so that rows are numbered by file
    wherever they are read; splits are whole files unless the contract says that values have no line breaks. Mutable rows
    without effective_at or updated_at raise when they are read.
    """
    if not files:
        raise FileNotFoundError(f"There is no file of {contract.table_name}")
    with ThreadPoolExecutor(16) as pool:
        headers = list(pool.map(lambda p: header(spark, p), files))
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path, columns in zip(files, headers):
        check_header(columns, contract, load_type, path.rsplit("/", 1)[1])
        by_header.setdefault(tuple(columns), []).append(path)
    parts = [_numbered(read_delimited(spark, paths, columns=list(columns), multiline=contract.multiline), columns[0]) for columns, paths in by_header.items()]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if contract.is_mutable:
        missing = (F.coalesce("effective_at", F.lit("")) == "") | (F.coalesce("updated_at", F.lit("")) == "")
        message = F.concat(F.col("_source_file_name"), F.lit(": row "), F.col("_source_row_number"), F.lit(" lacks effective_at or updated_at"))
        rows = rows.withColumn("effective_at", F.when(missing, F.raise_error(message).cast("string")).otherwise(F.col("effective_at")))
    return rows


def _numbered(rows: DataFrame, first_column: str) -> DataFrame:
    """rows with their file's name, path and time and their place in it, the header being row 1."""
    data = [F.col(f"`{c}`") for c in rows.columns]
    placed = rows.select(*data, F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"), F.col("_metadata").alias("_meta"), F.monotonically_increasing_id().alias("_id"))
    # One row for each split; read from a file its size is known, and Spark joins it without a shuffle of the rows.
    splits = placed.groupBy("_path", "_start").agg(F.count(F.lit(1)).alias("_rows"), F.count(F.col(f"`{first_column}`")).alias("_filled"), F.min("_id").alias("_first"))
    before = F.sum("_rows").over(Window.partitionBy("_path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1))
    offsets = splits.select(F.col("_path").alias("_p"), F.col("_start").alias("_s"), "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    met = placed.join(materialise(offsets, "splits"), (F.col("_path") == F.col("_p")) & (F.col("_start") == F.col("_s")))
    return met.select(
        *data, F.col("_meta.file_name").alias("_source_file_name"), F.col("_path").alias("_source_file_path"),
        F.date_format("_meta.file_modification_time", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX").alias("_source_file_modified_at"), (F.col("_id") - F.col("_first") + F.col("_before") + 2).cast("string").alias("_source_row_number"),
    )


def read_manifest(spark: SparkSession, root: str, source_date: str, table_names: Sequence[str], load_type: str) -> dict[str, int]:
    """Expected counts by table. A wrong date raises, so do tables a full manifest lacks; tables nobody asked for are skipped."""
    path = f"{root}/{load_type}_sources/{source_date}/manifest.csv"
    if not Files(spark).exists(path):
        raise FileNotFoundError(f"There is no {load_type} manifest at {path}")
    rows = read_delimited(spark, path).where(F.col("table_name").isin(*table_names)).collect()
    for r in rows:
        if r.source_date != source_date:
            raise ValueError(f"The manifest of {source_date} dates {r.table_name} to {r.source_date}")
    expected = {r.table_name: int(r.row_count) for r in rows}
    missing = sorted(set(table_names) - set(expected))
    if missing and load_type == "full":
        raise ValueError(f"The full manifest doesn't list {missing}")
    return expected


def backfill(spark: SparkSession, root: str, table_names: Sequence[str], old: str = "old_datasets") -> list[str]:
    """Copies files the root lacks from the folder of old ones; returns what was copied."""
    files = Files(spark)
    copied = [t for t in table_names if not files.exists(f"{root}/{t}") and files.exists(f"{root}/{old}/{t}")]
    for t in copied:
        files.copy(f"{root}/{old}/{t}", f"{root}/{t}")
    return copied


def archive_path(output_root: str, system: str, table_name: str, extract: str, ingest_timestamp: str, run_id: str, file_name: str) -> str:
    stem = table_name.rsplit(".", 1)[0]
    return f"{output_root}/raw/source_system={system}/dataset={stem}/source_extract={extract}/ingest_date={ingest_timestamp[:10]}/ingest_hour={ingest_timestamp[11:13]}/run_id={run_id}/{file_name}"
