"""Tables in and out: CSV as text, with missing values or with types, page snapshots, appended progress, names of outputs."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Cells that count as missing where such are read.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def parquet(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _csv(spark: SparkSession):
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"')


def csv_columns(spark: SparkSession, path) -> list[str]:
    """The header of a CSV, or of the first file of several."""
    return _csv(spark).option("inferSchema", False).csv(path).columns


def csv_text(spark: SparkSession, path, columns: list[str] | None = None, missing: tuple[str, ...] = ()) -> DataFrame:
    """CSV with every column text and blanks kept as ""; cells in ``missing`` become null.  A byte order mark is no text."""
    names = columns or csv_columns(spark, path)
    rows = _csv(spark).schema(T.StructType([T.StructField(c, T.StringType()) for c in names])).csv(path)
    cells = [F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in names]
    if missing:
        cells = [F.when(~cell.isin("", *missing), cell) for cell in cells]
    return rows.select(*[cell.alias(c) for cell, c in zip(cells, names)])


def csv_missing(spark: SparkSession, path, columns: list[str] | None = None) -> DataFrame:
    """CSV with every column text and the usual marks of missing values null."""
    return csv_text(spark, path, columns, MISSING)


def csv_typed(spark: SparkSession, path) -> DataFrame:
    """CSV with the types its values have."""
    return _csv(spark).option("inferSchema", True).csv(path)


def write_csv(rows: DataFrame, path: str, files: int | None = None) -> None:
    """CSV with a header, nothing as ""; in ``files`` files if that is asked for."""
    text = rows.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in rows.columns])
    (text.coalesce(files) if files else text).write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def append(rows: DataFrame, path: str, names: list[str]) -> None:
    """Append the columns ``names``, as text; others are left out, missing ones are blank."""
    rows.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) if c in rows.columns else F.lit("").alias(c) for c in names]).write.mode("append").parquet(path)


def with_source_file(rows: DataFrame, name: str = "__source_file") -> DataFrame:
    return rows.withColumn(name, F.col("_metadata.file_name"))


def csv_files(spark: SparkSession, glob: str, columns: list[str]) -> DataFrame:
    """All files of a glob under one header, each row with the name of its file."""
    rows = _csv(spark).schema(T.StructType([T.StructField(c, T.StringType()) for c in columns])).csv(glob)
    named = rows.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns], F.col("_metadata.file_name").alias("__source_file"))
    return named


def snapshot(pages: DataFrame, now, days: int = 14) -> DataFrame:
    """Pages (``url``, ``fetched_at``, ...) not older than ``days``, keyed by the sha256 of the url."""
    return pages.where(F.col("fetched_at") >= F.lit(now) - F.expr(f"INTERVAL {days} DAYS")).withColumn("cache_key", F.sha2("url", 256))


def fresh_or_slow(fast: DataFrame, slow: DataFrame, key: str, value: str) -> DataFrame:
    """``key`` and ``value`` of the fast reading, or of the slow one where the fast one is blank."""
    f, s = fast.select(key, F.col(value).alias("_fast")), slow.select(key, F.col(value).alias("_slow"))
    return f.join(s, key, "left").select(key, F.when(F.trim(F.coalesce("_fast", F.lit(""))) != "", F.col("_fast")).otherwise(F.coalesce("_slow", F.lit(""))).alias(value))


def output_name(path: str, suffix: str) -> str:
    """The path with a suffix before its ending; ".csv" where it has none."""
    p = PurePosixPath(path)
    return str(p.with_name(p.stem + suffix + (p.suffix or ".csv")))


def inventory_outputs(path: str, folder: str) -> dict[str, str]:
    """Where the tables of an inventory go: the wide one and five long ones, named after the input."""
    stem = PurePosixPath(path).stem + "__bucketed_programs"
    names = {"wide": "", "long": "__long", "long_bucket_summary": "__long_bucket_summary", "long_programs": "__long_programs", "long_programs_agg": "__long_programs_agg", "long_signals": "__long_signals"}
    return {k: str(PurePosixPath(folder) / f"{stem}{v}.csv") for k, v in names.items()}


def batch_paths(path: str, batch: int) -> tuple[str, str]:
    """Output and progress of a batch."""
    stem = str(PurePosixPath(path).with_suffix(""))
    return f"{stem}__batch_{batch:03d}.csv", f"{stem}__batch_{batch:03d}__progress.csv"


def kept(rows: DataFrame) -> DataFrame:
    """``rows`` written once to the folder that driver and executors share (``spark.checkpoint.dir``) and read back, so that lineage ends there.

    Only where that is unset, on one machine, is it a temporary folder.
    """
    spark = rows.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="almanack-")
    path = f"{folder}/almanack-kept/{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
