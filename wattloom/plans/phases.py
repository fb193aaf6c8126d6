"""The phases of the whole job. Each reads and writes tables under one folder, so that
phases can run alone, and a lost driver costs only the phase it was in."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.fixed_values import LEARNING_FRACTIONS, PERMUTATION_REPEATS, STEP
from wattloom.operators import (
    compare, evaluate, explain, ordered, profiles, quality, sweep, train)
from wattloom.operators.clean import union_by_name
from wattloom.operators.features import FEATURES, engineer_features
from wattloom.operators.split import prepare_split
from wattloom.session import durable
from wattloom.sources import csv_files, external, store
from wattloom.streaming import ingest

log = logging.getLogger(__name__)
TARGET = "total_power"
INPUTS = [c for c in FEATURES if c != TARGET]
ORDER = ["timestamp"]
READ = "_long_reading"  # in a mixed folder: the steps of the grid that had a long reading


def quality_report(features: DataFrame) -> DataFrame:
    """Phase 1 on existing data: one (section, item, value) table."""
    def rows(section: str, df: DataFrame, item: str, value: str) -> DataFrame:
        return df.select(F.lit(section).alias("section"), F.col(item).alias("item"),
                         F.col(value).cast("double").alias("value"))

    complete = profiles.completeness(features).select(
        F.lit("completeness_pct").alias("item"), "completeness_pct")
    power = features.agg(F.avg(TARGET).alias("mean"), F.max(TARGET).alias("max"),
                         F.min(TARGET).alias("min")).unpivot(
        [], ["mean", "max", "min"], "item", "value")
    hourly = profiles.hourly_profile(features, [TARGET]).withColumn(
        "item", F.col("hour").cast("string"))
    weekend = profiles.weekend_profile(features).withColumn(
        "item", F.concat_ws("/", "is_weekend", "hour"))
    realism = quality.appliance_realism(features)
    return union_by_name(
        rows("completeness", complete, "item", "completeness_pct"),
        rows("power", power, "item", "value"),
        rows("hourly_power", hourly, "item", "mean_value"),
        rows("weekend_power", weekend, "item", TARGET),
        rows("realism_passed", realism, "appliance", "passed"),
        rows("correlation", profiles.target_correlations(features), "feature", "r"))


def run_ingest(spark: SparkSession, messages: str, out: str) -> None:
    """Phase 2: the message folder into tables."""
    ingest.ingest(spark, messages, out)


def build_features(long: DataFrame, step: str = STEP) -> DataFrame:
    """Long readings to the features over all sensors in them."""
    return sweep.swept_features(durable(sweep.bin_means(sweep.tick_means(long), step)), step)


def run_preprocessing(spark: SparkSession, raw: str, out: str, step: str = STEP) -> DataFrame:
    """Phase 3, first half: raw files to stored readings and the feature table.

    Long files are binned and swept, for any number of sensors of any names. Wide files are
    taken as they are. Features are computed per header, as a column that one file lacks is
    no gap in its rows. Where both layouts have a feature row of one time, that of the long
    files stays if the step had a long reading; a step that was only filled gives way to the
    wide row. Stored are `binned` (a row per sensor and bin), `wide/0`, `wide/1` ... (one for
    each header) and `features`.
    """
    known = csv_files.folder_headers(spark, raw)
    kinds = {csv_files.detect_format(n) for n in known.values()}
    if not kinds:
        raise FileNotFoundError(f"no readable CSV files in {raw}")
    parts = {}
    if kinds & {"long", "headerless"}:
        ticks = sweep.tick_means(csv_files.load_long(spark, raw, known=known))
        binned = store.rewritten(sweep.bin_means(ticks, step), f"{out}/binned")
        parts["long"] = sweep.swept_features(binned, step, mark=READ)
    if "wide" in kinds:
        shapes = []
        for i, shape in enumerate(csv_files.load_wide_shapes(spark, raw, known)):
            shape = store.rewritten(shape, f"{out}/wide/{i}")
            shapes.append(engineer_features(shape))
            rows = shape.count()
            log.info("wide header %d: %d of %d rows lack an input", i,
                     rows - shapes[-1].count(), rows)
        if shapes:
            parts["wide"] = union_by_name(*shapes)
    if not parts:
        raise ValueError(f"no time column in {raw}")
    features = next(iter(parts.values()))
    if len(parts) == 2:
        read = parts["long"].where(READ).drop(READ)
        filled = parts["long"].where(~F.col(READ)).drop(READ)
        wide = parts["wide"].join(read.select("timestamp"), "timestamp", "left_anti")
        features = read.unionByName(wide).unionByName(
            filled.join(wide.select("timestamp"), "timestamp", "left_anti"))
    return store.rewritten(features.drop(READ), f"{out}/features")


def run_split(spark: SparkSession, out: str) -> None:
    """Phase 3, second half: split and scale the stored features."""
    features = spark.read.parquet(f"{out}/features").drop("date")
    rows, params = prepare_split(features, INPUTS, TARGET, ORDER)
    store.save_split(rows, params, INPUTS, f"{out}/split")


def run_models(spark: SparkSession, out: str, grids: dict | None = None, folds: int | None = None,
               ) -> dict[str, DataFrame]:
    """Phase 4: train, evaluate, compare and diagnose."""
    rows, _, inputs = store.load_split(spark, f"{out}/split")
    train_rows, test_rows = rows.where("split = 'train'"), rows.where("split = 'test'")
    k = folds or train.FOLDS
    tagged = durable(ordered.contiguous_folds(train_rows, ORDER, k))
    models = train.train_all(tagged, inputs, TARGET, grids, folds=k)
    train.save_models(spark, models, f"{out}/models")

    predicted = durable(train.predict_all(models, rows))
    tested = predicted.where("split = 'test'")
    results = {"evaluation": evaluate.evaluate(tested, TARGET),
               "gaps": evaluate.train_test_gap(predicted, TARGET),
               "normality": evaluate.residual_normality(tested, TARGET, "timestamp"),
               "histogram": evaluate.residual_histogram(tested, TARGET)}
    if len(models) > 1:
        results["comparisons"] = evaluate.compare_models(tested, TARGET, list(models))
    scored, failed, curves = [], [], []
    prefixes = durable(ordered.prefix_rank(train_rows, ORDER, LEARNING_FRACTIONS)[0])
    for name, m in models.items():
        linear, learner = name == "LinearRegression", train.LEARNERS[name]
        try:
            scored += train.linear_fold_scores(tagged, inputs, TARGET) if linear else \
                train.fold_scores(learner, tagged, inputs, TARGET, name, folds=k, **m.params)
        except Exception as e:  # one model's folds must not end the phase
            log.warning("%s: cross-validation failed: %s", name, e)
            failed.append((name, f"FAILED: {str(e).splitlines()[0] if str(e) else type(e).__name__}"))
        if linear:
            curves += train.linear_learning_curve(prefixes, test_rows, inputs, TARGET)
            results["coefficients"] = train.coefficient_table(
                spark, inputs, list(m.model.coefficients), m.model.intercept)
        else:
            curves += train.learning_curve(learner, prefixes, test_rows, inputs, TARGET, name,
                                           **m.params)
    results["fold_scores"] = spark.createDataFrame(scored, "model string, fold int, r2 double")
    results["stability"] = evaluate.with_failures(
        evaluate.cv_stability(results["fold_scores"]), failed)
    results["learning_curves"] = spark.createDataFrame(
        curves, "model string, fraction double, n bigint, train_r2 double, test_r2 double")
    for name, df in results.items():
        store.write_result(df, f"{out}/results/{name}")
    saved = {name: spark.read.parquet(f"{out}/results/{name}") for name in results}
    store.write_result(store.summary_report(
        saved["gaps"], saved["stability"], saved.get("coefficients"), saved["normality"]),
        f"{out}/results/summary")
    return saved


def run_explain(spark: SparkSession, out: str, repeats: int = PERMUTATION_REPEATS,
                ) -> dict[str, DataFrame]:
    """Phase 5: permutation importance and feature power of every saved model."""
    rows, _, inputs = store.load_split(spark, f"{out}/split")
    test = durable(ordered.row_index(rows.where("split = 'test'"), ORDER))
    models = train.load_models(spark, f"{out}/models")
    importance, power = [], []
    for name, m in models.items():
        importance.append(explain.permutation_importance(
            test, inputs, TARGET, m.predict, name, repeats=repeats))
        power.append(explain.decompose_features(
            test, inputs, TARGET, m.predict, name, repeats=repeats))
    store.write_result(union_by_name(*importance), f"{out}/results/importance_raw")
    store.write_result(union_by_name(*power), f"{out}/results/power_raw")
    summary = explain.importance_summary(spark.read.parquet(f"{out}/results/importance_raw"))
    store.write_result(summary, f"{out}/results/importance")
    summary = spark.read.parquet(f"{out}/results/importance")
    results = {"importance": summary,
               "importance_matrix": explain.importance_matrix(summary, list(models)),
               "decomposition": explain.decomposition_summary(
                   spark.read.parquet(f"{out}/results/power_raw"))}
    for name in ("importance_matrix", "decomposition"):
        store.write_result(results[name], f"{out}/results/{name}")
    return results


def run_validation(spark: SparkSession, out: str, appliances: str | None = None,
                   smart_home: str | None = None) -> dict[str, DataFrame]:
    """Phase 6: comparison with the external data sets found, and temporal analysis."""
    features = spark.read.parquet(f"{out}/features").drop("date")
    parts: Sequence[DataFrame] = []
    for path, loader, name in ((appliances, external.load_appliances, "Appliances"),
                               (smart_home, external.load_smart_home, "Smart home")):
        if not path:
            continue
        real, mapping = loader(spark, path)
        if real is not None:
            found = compare.validate_against(features, real, mapping, name)
            parts = [*parts, found] if found is not None else parts
    results = {"daily": profiles.daily_stats(features),
               "hourly_by_day": profiles.hourly_by_day(features),
               "day_distribution": profiles.day_distribution(features)}
    if parts:
        results["validation"] = union_by_name(*parts)
    else:
        log.warning("no external data set found")
    for name, df in results.items():
        store.write_result(df, f"{out}/results/{name}")
    saved = {name: spark.read.parquet(f"{out}/results/{name}") for name in results}
    totals = {"contrast": profiles.weekday_weekend_contrast(saved["daily"])}
    if parts:
        totals["totals"] = compare.validation_totals(saved["validation"])
    for name, df in totals.items():
        store.write_result(df, f"{out}/results/{name}")
        saved[name] = spark.read.parquet(f"{out}/results/{name}")
    return saved
