"""Folders of CSV files with readings, in the long or the wide layout."""

from __future__ import annotations

import csv
import io
import logging

import pyarrow as pa
from pyarrow import fs as pa_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.functions.columns import number, parse_ts
from wattloom.operators.clean import LONG_COLUMNS, clean_long, union_by_name

log = logging.getLogger(__name__)


def list_csv(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the CSV files in a folder, sorted; contents are not read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
             .load(folder).select("path").orderBy("path").collect())
    if not files:
        raise FileNotFoundError(f"no CSV files in {folder}")
    return [r["path"] for r in files]


def _first_line(path: str) -> str | None:
    """The first line of a file, read block by block; null if its file system is not known
    here. An unreadable file has an empty one."""
    try:
        system, inner = pa_fs.FileSystem.from_uri(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, ImportError, OSError):
        return None
    try:
        with system.open_input_stream(inner) as stream:
            held = b""
            while b"\n" not in held:
                block = stream.read(1 << 16)
                if not block:
                    break
                held += block
    except OSError as e:
        log.warning("skipping %s: %s", path, e)
        return ""
    return held.split(b"\n")[0].rstrip(b"\r").decode("utf-8-sig", "replace")


def _names(line: str | None) -> list[str] | None:
    return next(csv.reader(io.StringIO(line))) if line and line.strip() else None


def header_of(spark: SparkSession, path: str) -> list[str] | None:
    """Names in the first line of one file, or None if there is none."""
    first = spark.read.text(path).limit(1).collect()
    return _names(first[0]["value"]) if first else None


def headers(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """Header of every readable file, from one job over the paths, in which tasks read the
    first block of their files; the others are skipped with a warning. A file system that
    only Spark's own readers know costs one small job for each of its files."""
    def peek(batches):
        for batch in batches:
            found = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(_first_line, found), pa.string())],
                names=["path", "line"])
    tasks = min(len(paths), max(1, spark.sparkContext.defaultParallelism))
    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(tasks)
    lines = {r["path"]: r["line"] for r in
             listed.mapInArrow(peek, "path string, line string").collect()}
    found = {}
    for path in paths:
        try:
            found[path] = (header_of(spark, path) if lines[path] is None
                           else _names(lines[path]))
        except Exception as e:
            log.warning("skipping %s: %s", path, e)
            continue
        if found[path] is None:
            log.warning("skipping %s: no header", path)
    return {p: n for p, n in found.items() if n is not None}


def unique_names(names: list[str]) -> list[str]:
    """Column names that differ in more than case and hold no backtick; an unnamed column is
    `_c` and its place. Of names that differ in case alone, a lower-case one stays as it is."""
    plain = [n.replace("`", "'") or f"_c{i}" for i, n in enumerate(names)]
    out, taken = {}, set()
    for i in sorted(range(len(plain)), key=lambda i: plain[i] != plain[i].lower()):
        name, k = plain[i], 2
        while name.lower() in taken:
            name, k = f"{plain[i]}__{k}", k + 1
        taken.add(name.lower())
        out[i] = name
    return [out[i] for i in range(len(plain))]


def detect_format(names: list[str]) -> str:
    """'wide' if there are temperature and power columns, 'long' if there is a sensor
    type or a room, 'headerless' for a first line of five values, else 'wide'."""
    if any(c.startswith("temperature_") for c in names) and any(
            c.startswith("power_") for c in names):
        return "wide"
    if "sensor_type" in names or "room" in names:
        return "long"
    if len(names) == len(LONG_COLUMNS) and names[0][:4].isdigit():
        return "headerless"
    return "wide"


def _scan(spark: SparkSession, paths: list[str], names: list[str], header: bool) -> DataFrame:
    """Files of one header shape as text columns; types are applied by the loaders,
    so a bad value cannot fail the read and no inference pass is needed."""
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    return (spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE")
            .option("enforceSchema", True).csv(paths).toDF(*unique_names(names)))


def folder_headers(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """The header of every readable CSV file of a folder."""
    return headers(spark, list_csv(spark, folder))


def scan_shapes(spark: SparkSession, folder: str, kind: str | None = None,
                known: dict[str, list[str]] | None = None) -> list[DataFrame]:
    """One table for each different header among the CSV files of a folder (or those of one
    layout). Every file is sniffed, so a folder may mix layouts; `known` headers are not
    read again."""
    known = folder_headers(spark, folder) if known is None else known
    shapes: dict[tuple[str, ...], list[str]] = {}
    for path, names in known.items():
        layout = detect_format(names)
        if kind is None or layout == kind or (kind == "long" and layout == "headerless"):
            key = tuple(LONG_COLUMNS) + ("",) if layout == "headerless" else tuple(names)
            shapes.setdefault(key, []).append(path)
    if not shapes:
        raise FileNotFoundError(f"no readable {kind or 'CSV'} files in {folder}")
    parts = []
    for names, paths in shapes.items():
        headerless = names == tuple(LONG_COLUMNS) + ("",)
        parts.append(_scan(spark, paths, list(LONG_COLUMNS if headerless else names),
                           header=not headerless))
    return parts


def scan_csv_dir(spark: SparkSession, folder: str, kind: str | None = None,
                 known: dict[str, list[str]] | None = None) -> DataFrame:
    """The tables of `scan_shapes` united by column name."""
    return union_by_name(*scan_shapes(spark, folder, kind, known))


def load_long(spark: SparkSession, folder: str, counted=None,
              known: dict[str, list[str]] | None = None) -> DataFrame:
    """Clean long readings of a folder. `counted` (an Observation) gets the number of
    rows read and dropped, in the same pass."""
    raw = scan_csv_dir(spark, folder, "long", known)
    for c in LONG_COLUMNS:
        if c not in raw.columns:
            raw = raw.withColumn(c, F.lit(None).cast("string"))
    return clean_long(raw, counted)


def _wide_rows(raw: DataFrame) -> DataFrame | None:
    """Typed rows of a wide table; None without a time column, which may be unnamed."""
    unnamed = [c for c in ("_c0", "Unnamed: 0") if c in raw.columns]
    times = [F.col(f"`{c}`") for c in (["timestamp"] if "timestamp" in raw.columns else []) + unnamed]
    if not times:
        return None
    values = [c for c in raw.columns if c not in ("timestamp", *unnamed)]
    return raw.select(parse_ts(F.coalesce(*times)).alias("timestamp"),
                      *[number(F.col(f"`{c}`")).alias(c) for c in values])


def load_wide_shapes(spark: SparkSession, folder: str,
                     known: dict[str, list[str]] | None = None) -> list[DataFrame]:
    """Wide readings of a folder, one table for each different header."""
    parts = [_wide_rows(raw) for raw in scan_shapes(spark, folder, "wide", known)]
    if None in parts:
        log.warning("%d wide headers in %s have no time column", parts.count(None), folder)
    return [p for p in parts if p is not None]


def load_wide(spark: SparkSession, folder: str,
              known: dict[str, list[str]] | None = None) -> DataFrame:
    """Wide readings of a folder; the time column may be the unnamed first one."""
    rows = _wide_rows(scan_csv_dir(spark, folder, "wide", known))
    if rows is None:
        raise ValueError(f"no time column in {folder}")
    return rows


def load_features(spark: SparkSession, path: str) -> DataFrame:
    """A saved feature table: Parquet, or CSV by its ending."""
    if not path.rstrip("/").endswith(".csv"):
        return spark.read.parquet(path)
    names = header_of(spark, path)
    raw = _scan(spark, [path], names, header=True)
    ints = ("hour", "day_of_week", "is_weekend", "active_appliances")
    return raw.select(parse_ts("timestamp").alias("timestamp"), *[
        number(c).cast("int" if c in ints else "double").alias(c)
        for c in names if c != "timestamp"])
