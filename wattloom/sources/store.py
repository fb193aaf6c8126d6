"""Tables written by the jobs, and reading them back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.columns import half_even


def write_by_date(df: DataFrame, path: str, ts: str = "timestamp", mode: str = "overwrite") -> None:
    """Parquet partitioned by day, so that range filters read only their days.

    Rows are clustered by day first: each task then writes few days. A day too large
    for one task is split again by AQE, as the rebalance allows it.
    """
    (df.withColumn("date", F.col(ts).cast("date")).hint("rebalance", "date")
     .write.mode(mode).partitionBy("date").parquet(path))


def rewritten(df: DataFrame, path: str) -> DataFrame:
    """`df` written by date and read again, also if it has no rows."""
    write_by_date(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path).drop("date")


def read_days(spark: SparkSession, path: str, first: str | None = None,
              last: str | None = None) -> DataFrame:
    """Rows of a date range; the bounds prune partitions."""
    df = spark.read.parquet(path)
    if first:
        df = df.where(F.col("date") >= F.lit(first).cast("date"))
    if last:
        df = df.where(F.col("date") <= F.lit(last).cast("date"))
    return df


def write_result(df: DataFrame, path: str, digits: dict[str, int] | None = None,
                 fmt: str = "parquet") -> None:
    """A result table, rounded per column; 'csv' gives one small file with a header."""
    for c, d in (digits or {}).items():
        df = df.withColumn(c, half_even(c, d))
    if fmt == "csv":
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    else:
        df.write.mode("overwrite").parquet(path)


def save_split(split: DataFrame, params: DataFrame, features: Sequence[str], folder: str) -> None:
    """Scaled rows with their side, the scaler, and the ordered feature list."""
    spark = split.sparkSession
    split.write.mode("overwrite").partitionBy("split").parquet(f"{folder}/rows")
    params.write.mode("overwrite").parquet(f"{folder}/scaler_params")
    spark.createDataFrame(list(enumerate(features)), "pos int, feature string").write.mode(
        "overwrite").parquet(f"{folder}/feature_list")


def load_split(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, list[str]]:
    listed = spark.read.parquet(f"{folder}/feature_list").orderBy("pos").collect()
    return (spark.read.parquet(f"{folder}/rows"), spark.read.parquet(f"{folder}/scaler_params"),
            [r["feature"] for r in listed])


def summary_report(gaps: DataFrame, stability: DataFrame, coefficients: DataFrame | None,
                   normality: DataFrame) -> DataFrame:
    """Diagnostics as (section, pos, line) rows, ending with the overall verdict.

    All inputs are small result tables.
    """
    fmt = F.format_string
    parts = [
        gaps.select(F.lit(1).alias("section"), F.col("model").alias("pos"), fmt(
            "%s  Train R2=%.5f  Test R2=%.5f  Gap=%.3f%%  [%s]", "model", "train_r2", "test_r2",
            "r2_gap_pct", "verdict").alias("line")),
        stability.where("cv_mean_r2 IS NOT NULL").select(F.lit(2), F.col("model"), fmt(
            "%s  Mean R2=%.5f  Std=%.5f  [%s]", "model", "cv_mean_r2", "cv_std_r2", "verdict")),
    ]
    if coefficients is not None:
        zero = F.coalesce(F.every(F.when(
            ~F.col("is_appliance_feature") & (F.col("feature") != "intercept"),
            F.col("effectively_zero"))), F.lit(True))
        parts.append(coefficients.agg(zero.alias("z")).select(F.lit(3), F.lit(""), F.when(
            F.col("z"), "Model correctly identifies appliance power as the predictor.").otherwise(
            "Model partially identifies appliance power as the predictor.")))
    parts.append(normality.select(F.lit(5), F.col("model"), fmt(
        "%s  Shapiro p=%.6f  Skew=%.4f  Kurt=%.4f  Normal=%s", "model", "shapiro_p", "skewness",
        "kurtosis", F.when(F.col("is_normal"), "Yes").otherwise("No"))))
    concern = F.coalesce(F.bool_or(F.col("verdict") == "OVERFITTING CONCERN"), F.lit(False))
    parts.append(gaps.agg(concern.alias("c")).select(F.lit(6), F.lit(""), F.when(
        F.col("c"), "WARNING: One or more models show signs of overfitting.").otherwise(
        "No evidence of overfitting detected.")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out
