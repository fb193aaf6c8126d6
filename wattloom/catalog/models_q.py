"""Queries over splitting, models, evaluation, validation and explanation."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattloom.catalog.base import (
    FEATURES_CTE, feature_table, query, r6, show, sql_half_even, sql_r6, table, with_)
from wattloom.fixed_values import FOLDS, LEARNING_FRACTIONS, PERMUTATION_REPEATS, SEED
from wattloom.operators import clean, compare, distribution, evaluate, explain, ordered, split, \
    train
from wattloom.operators.features import FEATURES
from wattloom.session import durable, work_path
from wattloom.sources import store

_r = lambda cols, digits=6: ", ".join(sql_r6(c, None, digits) for c in cols)
MODEL_INPUTS = [c for c in FEATURES if c != "total_power"]


# --- predictions: group means of order prices ------------------------------------

PRED_CTE = """raw AS (
  SELECT o.*, c_mktsegment FROM orders o JOIN customer ON o_custkey = c_custkey),
preds AS (
  SELECT o_orderkey, o_orderdate, o_totalprice AS y, row_number() OVER (
      ORDER BY o_orderdate, o_orderkey) - 1 AS row_id, count(*) OVER () AS n,
    avg(o_totalprice) OVER (PARTITION BY o_orderpriority) AS pred_priority,
    avg(o_totalprice) OVER (PARTITION BY c_mktsegment) AS pred_segment,
    avg(o_totalprice) OVER () AS pred_overall FROM raw),
tall AS (SELECT * FROM (
    SELECT o_orderkey, row_id, n, y, pred_priority AS priority, pred_segment AS segment,
      pred_overall AS overall FROM preds)
  UNPIVOT (y_pred FOR model IN (priority, segment, overall))),
scored AS (SELECT model, 1 - sum((y - y_pred) ** 2) / (var_pop(y) * count(*)) AS r2,
  sqrt(avg((y - y_pred) ** 2)) AS rmse, avg(abs(y - y_pred)) AS mae FROM tall GROUP BY model)"""
MODELS = ["priority", "segment", "overall"]


def predictions(spark, sf):
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    raw = orders.join(customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"),
                      "o_custkey").select("o_orderkey", "o_orderdate", "o_orderpriority",
                                          "c_mktsegment", F.col("o_totalprice").alias("y"))
    # Group means by aggregate and join: a window would hold a whole group in one task.
    first = raw.groupBy("o_orderpriority").agg(F.avg("y").alias("pred_priority"))
    second = raw.groupBy("c_mktsegment").agg(F.avg("y").alias("pred_segment"))
    overall = raw.agg(F.avg("y").alias("m")).first()["m"]
    return (raw.join(first, "o_orderpriority").join(second, "c_mktsegment")
            .withColumn("pred_overall", F.lit(overall)))


@query("j02_align_predictions", with_(PRED_CTE, f"""
SELECT o_orderkey, {_r(["y", "priority", "segment", "overall"])} FROM (
  SELECT o_orderkey, y, pred_priority AS priority, pred_segment AS segment,
    pred_overall AS overall FROM preds)"""))
def j02(spark, sf):
    preds = predictions(spark, sf)
    tall = evaluate.long_predictions(preds, ["o_orderkey"])
    joined = evaluate.join_predictions(preds.select("o_orderkey", "y"), tall, "o_orderkey")
    return show(joined.select("o_orderkey", "y", *[
        F.col(evaluate.PREFIX + m).alias(m) for m in MODELS]))


@query("m07_evaluate", with_(PRED_CTE, f"""
SELECT model, {_r(["r2", "rmse", "mae"])}, r2 >= 0.7 AS meets_r2_target,
  rmse <= 100 AS meets_rmse_target, mae <= 70 AS meets_mae_target FROM scored"""))
def m07(spark, sf):
    return show(evaluate.evaluate(predictions(spark, sf)))


@query("o02_sort_by_metric", with_(PRED_CTE, f"""
SELECT model, {_r(["mae"])}, row_number() OVER (ORDER BY mae DESC, model)::INT AS pos
FROM scored"""))
def o02(spark, sf):
    scored = evaluate.scores(predictions(spark, sf)).select("model", "mae")
    # One file of three rows in the order in which they were sorted.
    path = work_path(spark, "sorted")
    ordered.sorted_rows(scored, F.desc("mae"), "model").coalesce(1).write.parquet(path)
    return spark.read.parquet(path).select(
        "model", r6("mae"), (F.col("_metadata.row_index") + 1).cast("int").alias("pos"))


@query("o03_best_model", with_(PRED_CTE, f"""
SELECT model AS best_model, {sql_r6("r2", "best_r2")} FROM scored ORDER BY r2 DESC LIMIT 1"""))
def o03(spark, sf):
    return show(evaluate.best_model(evaluate.evaluate(predictions(spark, sf)), MODELS))


_PAIRS = [("priority", "segment"), ("priority", "overall"), ("segment", "overall")]


def _pair_sql(a, b):
    return f"""SELECT '{a}' AS model_a, '{b}' AS model_b, avg(ea) AS mae_a, avg(eb) AS mae_b,
  avg(ea - eb) / (stddev_samp(ea - eb) / sqrt(count(*))) AS t_statistic FROM (
  SELECT abs(y - pred_{a}) AS ea, abs(y - pred_{b}) AS eb FROM preds)"""


@query("m08_paired_t_test", with_(PRED_CTE, f"""
SELECT model_a, model_b, {_r(["mae_a", "mae_b", "t_statistic"])},
  CASE WHEN mae_a < mae_b THEN model_a ELSE model_b END AS better_model
FROM ({" UNION ALL ".join(_pair_sql(a, b) for a, b in _PAIRS)})"""))
def m08(spark, sf):
    out = evaluate.compare_models(predictions(spark, sf), models=MODELS)
    return show(out.drop("p_value", "significant"))


@query("j03_model_pairs", with_(PRED_CTE, f"""
SELECT model_a, model_b, abs(t_statistic) > 1.9603 AS significant
FROM ({" UNION ALL ".join(_pair_sql(a, b) for a, b in _PAIRS)})"""))
def j03(spark, sf):
    out = evaluate.compare_models(predictions(spark, sf), models=MODELS)
    return out.select("model_a", "model_b", "significant")


_GAP_CTE = PRED_CTE + """,
sided AS (SELECT *, CASE WHEN row_id < floor(n * (1 - 0.2::DOUBLE)) THEN 'train' ELSE 'test' END
  AS split FROM tall),
sides AS (SELECT model, split, 1 - sum((y - y_pred) ** 2) / (var_pop(y) * count(*)) AS r2,
  sqrt(avg((y - y_pred) ** 2)) AS rmse, avg(abs(y - y_pred)) AS mae FROM sided GROUP BY ALL),
gap AS (SELECT a.model, a.r2 AS ar2, b.r2 AS br2, a.rmse AS armse, b.rmse AS brmse, a.mae AS amae,
  b.mae AS bmae FROM sides a JOIN sides b ON a.model = b.model AND a.split = 'train'
  AND b.split = 'test')"""


def _split_predictions(spark, sf):
    return ordered.temporal_split(predictions(spark, sf), ["o_orderdate", "o_orderkey"])


@query("m09_train_test_gap", with_(_GAP_CTE, f"""
SELECT model, {sql_half_even("ar2", 5)} + 0 AS train_r2, {sql_half_even("br2", 5)} + 0 AS test_r2,
  {sql_half_even("ar2 - br2", 5)} + 0 AS r2_gap,
  {sql_half_even("(ar2 - br2) * 100", 3)} + 0 AS r2_gap_pct,
  {sql_half_even("armse", 2)} AS train_rmse, {sql_half_even("brmse", 2)} AS test_rmse,
  {sql_half_even("brmse - armse", 2)} + 0 AS rmse_gap, {sql_half_even("amae", 2)} AS train_mae,
  {sql_half_even("bmae", 2)} AS test_mae, {sql_half_even("bmae - amae", 2)} + 0 AS mae_gap,
  CASE WHEN ar2 - br2 < 0.01 THEN 'NO OVERFITTING' WHEN ar2 - br2 < 0.05 THEN 'MILD OVERFITTING'
    ELSE 'OVERFITTING CONCERN' END AS verdict FROM gap"""))
def m09(spark, sf):
    return show(evaluate.train_test_gap(_split_predictions(spark, sf)))


_MOMENTS = """,
res AS (SELECT model, y - y_pred AS e FROM tall),
cent AS (SELECT res.model, e, m, e - m AS d FROM res JOIN (
  SELECT model, avg(e) AS m FROM res GROUP BY model) USING (model))"""


@query("m13_residual_moments", with_(PRED_CTE + _MOMENTS, f"""
SELECT model, {sql_r6("avg(e)", "residual_mean", 3)}, {sql_r6("stddev_pop(e)", "residual_std", 3)},
  {sql_r6("avg(d ** 3) / avg(d ** 2) ** 1.5", "skewness", 4)},
  {sql_r6("avg(d ** 4) / avg(d ** 2) ** 2 - 3", "kurtosis", 4)} FROM cent GROUP BY model"""))
def m13(spark, sf):
    out = evaluate.residual_moments(predictions(spark, sf))
    return out.select("model", r6("residual_mean", digits=3), r6("residual_std", digits=3),
                      r6("skewness", digits=4), r6("kurtosis", digits=4))


@query("m13_residual_normality")
def m13_shapiro(spark, sf):
    return evaluate.residual_normality(predictions(spark, sf), key="o_orderkey")


@query("o05_bounded_sample", with_(PRED_CTE, """
SELECT least(count(*), 5000) AS n, least(count(DISTINCT o_orderkey), 5000) AS distinct_rows,
  true AS all_known FROM preds"""))
def o05(spark, sf):
    orders = table(spark, sf, "orders")
    sample = evaluate.bounded_sample(orders, "o_orderkey")
    known = sample.join(orders.select("o_orderkey"), "o_orderkey", "left_semi")
    return known.agg(F.count(F.lit(1)).alias("n"),
                     F.count_distinct("o_orderkey").alias("distinct_rows"),
                     F.every(F.col("o_orderkey").isNotNull()).alias("all_known"))


@query("a18_residual_histogram", with_(PRED_CTE + """,
res AS (SELECT model, y - y_pred AS e FROM tall),
r AS (SELECT model, min(e) AS lo, max(e) AS hi FROM res GROUP BY model),
b AS (SELECT res.model, least(floor((e - lo) / ((hi - lo) / 50)), 49)::INT AS bin, count(*) AS n
  FROM res JOIN r ON r.model = res.model GROUP BY 1, 2)""", """
SELECT f.model, i::INT AS bin, round(lo + (hi - lo) / 50 * i, 3) + 0 AS bin_low,
  round(lo + (hi - lo) / 50 * (i + 1), 3) + 0 AS bin_high, coalesce(n, 0)::BIGINT AS n
FROM (SELECT * FROM r, range(50) g(i)) f LEFT JOIN b ON b.model = f.model AND b.bin = f.i"""))
def a18(spark, sf):
    return show(evaluate.residual_histogram(predictions(spark, sf)), 3)


@query("a21_prediction_extents", with_(PRED_CTE, f"""
SELECT model, {sql_r6("least(min(y), min(y_pred))", "low")},
  {sql_r6("greatest(max(y), max(y_pred))", "high")},
  {sql_r6("avg(y - y_pred)", "residual_mean", 4)},
  {sql_r6("stddev_pop(y - y_pred)", "residual_std", 4)} FROM tall GROUP BY model"""))
def a21(spark, sf):
    out = evaluate.prediction_extents(predictions(spark, sf))
    return out.select("model", r6("low"), r6("high"), r6("residual_mean", digits=4),
                      r6("residual_std", digits=4))


# --- split and scaling -------------------------------------------------------------

_SPLIT_CTE = FEATURES_CTE + """,
pos AS (SELECT *, row_number() OVER (ORDER BY timestamp) - 1 AS row_id, count(*) OVER () AS n
  FROM features),
sided AS (SELECT *, CASE WHEN row_id < floor(n * (1 - 0.2::DOUBLE)) THEN 'train' ELSE 'test' END
  AS split FROM pos)"""


def _stored_features(spark, sf):
    """The feature table, stored first as the jobs do, since splitting scans it often."""
    return durable(feature_table(spark, sf))


def _scaler_sql(side):
    return " UNION ALL ".join(
        f"SELECT {i} AS pos, '{c}' AS feature, round(avg({c}), 9) + 0 AS mean, round(CASE WHEN "
        f"stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END, 9) + 0 AS scale FROM sided "
        f"WHERE split = '{side}'" for i, c in enumerate(MODEL_INPUTS))


@query("m01_scaler_params", with_(_SPLIT_CTE, _scaler_sql("train")))
def m01(spark, sf):
    _, params = split.prepare_split(_stored_features(spark, sf), MODEL_INPUTS, "total_power",
                                    ["timestamp"])
    return show(params, 9)


@query("m01_scaler_refit", with_(_SPLIT_CTE, _scaler_sql("test")))
def m01_refit(spark, sf):
    _, params = split.prepare_split(_stored_features(spark, sf), MODEL_INPUTS, "total_power",
                                    ["timestamp"], test_scaler="refit")
    return show(params, 9)


_SCALED = MODEL_INPUTS


@query("m01_scaled_rows", with_(_SPLIT_CTE + f""",
p AS (SELECT {", ".join(f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE "
                        f"stddev_pop({c}) END AS s_{c}" for c in _SCALED)}
  FROM sided WHERE split = 'train')""", f"""
SELECT timestamp, split, total_power, {", ".join(
    f"round(({c} - m_{c}) / s_{c}, 6) + 0 AS {c}" for c in _SCALED)} FROM sided, p"""))
def m01_rows(spark, sf):
    rows, _ = split.prepare_split(_stored_features(spark, sf), _SCALED, "total_power", ["timestamp"])
    return show(rows.select("timestamp", "split", "total_power", *_SCALED))


@query("a20_target_stats", with_(_SPLIT_CTE, f"""
SELECT split, count(*) AS n, {sql_r6("avg(total_power)", "mean", 9)},
  {sql_r6("stddev_pop(total_power)", "std", 9)}, {sql_r6("min(total_power)", "min", 9)},
  {sql_r6("max(total_power)", "max", 9)} FROM sided GROUP BY split"""))
def a20(spark, sf):
    tagged = ordered.temporal_split(_stored_features(spark, sf), ["timestamp"])
    return show(split.target_stats(tagged, "total_power"), 9)


@query("s10_split_round_trip", with_(_SPLIT_CTE, f"""
SELECT split, count(*) AS n, {len(_SCALED)}::BIGINT AS features, {sql_r6(
    "sum(total_power)", "total", 2)} FROM sided GROUP BY split"""))
def s10(spark, sf):
    rows, params = split.prepare_split(_stored_features(spark, sf), _SCALED, "total_power",
                                       ["timestamp"])
    folder = work_path(spark, "split")
    store.save_split(rows.select("timestamp", "split", "total_power", *_SCALED), params,
                     _SCALED, folder)
    back, _, names = store.load_split(spark, folder)
    return back.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.lit(len(names)).cast("bigint").alias("features"),
        r6(F.sum("total_power"), "total", 2))


# --- linear models on line items ----------------------------------------------------

LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
X = ["price", "discount"]
ALL_X = ["price", "discount", "quantity", "tax"]


def regression_table(spark, sf):
    """Discounted price from price and discount; the product term is left unexplained."""
    return table(spark, sf, "lineitem").select(
        *LINE_ORDER, (F.col("l_extendedprice") / 10000).alias("price"),
        (F.col("l_discount") * 10).alias("discount"),
        (F.col("l_quantity") / 10).alias("quantity"), (F.col("l_tax") * 10).alias("tax"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) / 10000).alias("y"))


REG_CTE = f"""reg AS (
  SELECT *, l_extendedprice / 10000 AS x1, l_discount * 10 AS x2,
    l_extendedprice * (1 - l_discount) / 10000 AS y,
    row_number() OVER (ORDER BY {", ".join(LINE_ORDER)}) - 1 AS row_id, count(*) OVER () AS n
  FROM lineitem),
folds AS (SELECT *, CASE WHEN row_id < (n % 5) * (n // 5 + 1) THEN row_id // (n // 5 + 1)
  ELSE (row_id - (n % 5)) // (n // 5) END AS fold FROM reg)"""
_FIT = """g, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, covar_pop(x1, x1) AS s11,
  covar_pop(x1, x2) AS s12, covar_pop(x2, x2) AS s22, covar_pop(x1, y) AS s1y,
  covar_pop(x2, y) AS s2y"""
_COEF = """SELECT g, b1, b2, my - b1 * m1 - b2 * m2 AS b0 FROM (
  SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1,
    (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2 FROM fit)"""
_R2 = "1 - sum((y - b0 - b1 * x1 - b2 * x2) ** 2) / (var_pop(y) * count(*))"


@query("m02_linear_regression", with_(REG_CTE + f""",
fit AS (SELECT {_FIT} FROM reg, (SELECT 0 AS g) GROUP BY g), coef AS ({_COEF})""", f"""
SELECT {_r(["b0", "b1", "b2"])}, (SELECT round({_R2}, 6) FROM reg, coef) AS r2 FROM coef"""))
def m02(spark, sf):
    rows = regression_table(spark, sf)
    model = train.Fitted("LinearRegression", X, train.fit_linear(rows, X, "y"))
    r2 = evaluate.scores(model.predict(rows)).select(r6("r2"))
    b = model.model
    return r2.select(r6(F.lit(float(b.intercept)), "b0"),
                     r6(F.lit(float(b.coefficients[0])), "b1"),
                     r6(F.lit(float(b.coefficients[1])), "b2"), "r2")


@query("m02_residual_invariants", with_(REG_CTE, " UNION ALL ".join(
    f"SELECT '{x}' AS term, 0.0::DOUBLE AS moment WHERE (SELECT count(*) FROM reg) > 0"
    for x in ["intercept", *ALL_X])))
def m02_invariants(spark, sf):
    # With all four inputs: residuals are centred and uncorrelated with each input.
    rows = regression_table(spark, sf)
    model = train.Fitted("LinearRegression", ALL_X, train.fit_linear(rows, ALL_X, "y"))
    e = F.col("y") - F.col("pred_LinearRegression")
    sums = model.predict(rows).agg(F.avg(e).alias("intercept"),
                                   *[F.avg(e * F.col(c)).alias(c) for c in ALL_X])
    return show(clean.unpivot(sums, [], ["intercept", *ALL_X], "term", "moment"))


@query("m03_random_forest")
def m03(spark, sf):
    rows = ordered.temporal_split(regression_table(spark, sf), LINE_ORDER)
    train_rows = rows.where("split = 'train'")
    forest = train.Fitted("RandomForest", ALL_X, train.fit_forest(
        train_rows, ALL_X, "y", numTrees=10, maxDepth=6))
    return evaluate.scores(forest.predict(rows), "y", ["split"])


@query("m04_mlp")
def m04(spark, sf):
    from wattloom.operators import mlp
    rows = regression_table(spark, sf)
    net = train.Fitted("MLPRegressor", ALL_X, mlp.fit(
        rows, ALL_X, "y", hidden=(16, 8), learningRate=0.01, epochs=4))
    return evaluate.scores(net.predict(rows))


@query("m06_grid_search")
def m06(spark, sf):
    tagged = ordered.contiguous_folds(regression_table(spark, sf), LINE_ORDER, 2).persist()
    results = train.grid_search(train.fit_forest, tagged, X, "y", {
        "numTrees": [3], "maxDepth": [2, 4], "minSplit": [5], "subsamplingRate": [0.5]}, folds=2)
    tagged.unpersist()
    return spark.createDataFrame(
        [(r["combo"], r["params"], r["fold"], r["train_rmse"], r["val_rmse"]) for r in results],
        "combo int, params string, fold int, train_rmse double, val_rmse double")


@query("w04_fold_scores", with_(REG_CTE + f""",
fit AS (SELECT {_FIT} FROM folds JOIN range(5) k(g) ON fold <> g GROUP BY g),
coef AS ({_COEF})""", f"""
SELECT 'LinearRegression' AS model, fold::INT AS fold, round({_R2}, 6) AS r2
FROM folds JOIN coef ON g = fold GROUP BY fold"""))
def w04_scores(spark, sf):
    tagged = ordered.contiguous_folds(regression_table(spark, sf), LINE_ORDER)
    found = train.linear_fold_scores(tagged, X, "y")
    return show(spark.createDataFrame(found, "model string, fold int, r2 double"))


@query("m10_cv_stability", with_(REG_CTE + f""",
fit AS (SELECT {_FIT} FROM folds JOIN range(5) k(g) ON fold <> g GROUP BY g),
coef AS ({_COEF}),
r AS (SELECT {_R2} AS r2 FROM folds JOIN coef ON g = fold GROUP BY fold)""", f"""
SELECT 'LinearRegression' AS model, {sql_half_even("avg(r2)", 5)} AS cv_mean_r2,
  {sql_half_even("stddev_pop(r2)", 5)} AS cv_std_r2, {sql_half_even("min(r2)", 5)} AS cv_min_r2,
  {sql_half_even("max(r2)", 5)} AS cv_max_r2, {sql_half_even("max(r2) - min(r2)", 5)} AS cv_range,
  {sql_half_even("stddev_pop(r2) / abs(avg(r2)) * 100", 3)} AS cv_coeff_variation,
  CASE WHEN stddev_pop(r2) / abs(avg(r2)) * 100 < 5 THEN 'STABLE' ELSE 'UNSTABLE' END AS verdict
FROM r"""))
def m10(spark, sf):
    tagged = ordered.contiguous_folds(regression_table(spark, sf), LINE_ORDER, FOLDS)
    found = spark.createDataFrame(train.linear_fold_scores(tagged, X, "y"),
                                  "model string, fold int, r2 double")
    return evaluate.cv_stability(found)


@query("m11_coefficients", with_(REG_CTE + f""",
fit AS (SELECT {_FIT} FROM reg, (SELECT 0 AS g) GROUP BY g), coef AS ({_COEF})""", " UNION ALL ".join(
    f"SELECT {i} AS pos, '{f}' AS feature, {sql_half_even(b, 4)} + 0 AS coefficient, "
    f"{sql_half_even(f'abs({b})', 4)} + 0 AS abs_coefficient, false AS is_appliance_feature, "
    f"{'false' if f == 'intercept' else f'abs({b}) < 0.001'} AS effectively_zero FROM coef"
    for i, (f, b) in enumerate([("price", "b1"), ("discount", "b2"), ("intercept", "b0")]))))
def m11(spark, sf):
    model = train.fit_linear(regression_table(spark, sf), X, "y")
    return show(train.coefficient_table(spark, X, list(model.coefficients), model.intercept))


@query("m12_learning_curve", with_(REG_CTE + f""",
cutoff AS (SELECT floor(any_value(n) * (1 - 0.2::DOUBLE))::BIGINT AS c FROM reg),
steps AS (SELECT unnest({LEARNING_FRACTIONS}::DOUBLE[]) AS g),
pre AS (SELECT g, x1, x2, y FROM reg, cutoff, steps WHERE row_id < floor(c * g)),
held AS (SELECT x1, x2, y FROM reg, cutoff WHERE row_id >= c),
fit AS (SELECT {_FIT} FROM pre GROUP BY g), coef AS ({_COEF}),
inside AS (SELECT pre.g, count(*) AS n, {_R2} AS r2 FROM pre JOIN coef ON coef.g = pre.g
  GROUP BY pre.g),
outside AS (SELECT g, {_R2} AS r2 FROM held, coef GROUP BY g)""", """
SELECT 'LinearRegression' AS model, inside.g AS fraction, n,
  round(inside.r2, 6) + 0 AS train_r2, round(outside.r2, 6) + 0 AS test_r2
FROM inside JOIN outside ON outside.g = inside.g"""))
def m12(spark, sf):
    rows = ordered.temporal_split(regression_table(spark, sf), LINE_ORDER)
    tagged, _ = ordered.prefix_rank(rows.where("split = 'train'"), LINE_ORDER, LEARNING_FRACTIONS)
    curve = train.linear_learning_curve(tagged, rows.where("split = 'test'"), X, "y")
    return show(spark.createDataFrame(
        curve, "model string, fraction double, n bigint, train_r2 double, test_r2 double"))


@query("s11_model_round_trip")
def s11(spark, sf):
    rows = regression_table(spark, sf)
    models = {"LinearRegression": train.Fitted("LinearRegression", X,
                                               train.fit_linear(rows, X, "y"))}
    folder = work_path(spark, "models")
    train.save_models(spark, models, folder)
    return evaluate.scores(train.predict_all(train.load_models(spark, folder), rows))


# --- explanation ----------------------------------------------------------------------

REPEATS = 3  # in the queries of the benchmark; the others below use the documented number
LINEAR = train.LinearFormula([0.95, -0.4], 0.2)
_pred = lambda a, b: f"(b0 + b1 * {a} + b2 * {b})"


def _fixed(df, column):
    return df.withColumn(column, LINEAR.column(X))


def _key_sql(rnd, part):
    start = (SEED * 1000003 + rnd * 104729 + part * 1299709 + 12345) % 2147483647
    mixed = f"((({start} + g * 7919) % 2147483647) * 48271 % 2147483647)"
    return f"(({mixed} * {mixed} + 1) % 2147483647)"


def _round_sql(source, rnd):
    z, target, size = ("r", "l", "a") if rnd % 2 == 0 else ("l", "r", "b")
    return (f"SELECT * REPLACE (({target} + (u * u + {_key_sql(rnd, 2)}) % 2147483647 % {size})"
            f" % {size} AS {target}) FROM (SELECT * EXCLUDE (u), ({z} * {_key_sql(rnd, 0)}"
            f" + {_key_sql(rnd, 1)}) % 2147483647 AS u FROM ({source}))")


def _walk_sql(source):
    """One application of the permutation to `x`, for numbers that have not arrived."""
    body = f"SELECT *, x // b AS l, x % b AS r, 0::BIGINT AS u FROM ({source})"
    for rnd in range(4):
        body = _round_sql(body, rnd)
    return (f"SELECT g, id, n, a, b, CASE WHEN going AND l * b + r < n THEN false ELSE going END"
            f" AS going, CASE WHEN going THEN l * b + r ELSE x END AS x FROM ({body})")


def _perm_cte(repeats, rows):
    """perm: for each repeat g and row number id, the partner x. `rows` has row_id, x1, x2, y."""
    body = ("SELECT g, row_id AS id, n, a, -((-n) // a) AS b, true AS going, row_id AS x FROM ("
            "SELECT row_id, n, CASE WHEN floor(sqrt(n - 1)) ** 2 <= n - 1 THEN floor(sqrt(n - 1))"
            f"::BIGINT ELSE floor(sqrt(n - 1))::BIGINT - 1 END + 1 AS a FROM {rows}), "
            f"range({repeats}) t(g)")
    body = body.replace("-((-n) // a)", "(n + a - 1) // a")
    for _ in range(6):  # the chance of a longer walk is n ** -3
        body = _walk_sql(body)
    return f"""perm AS MATERIALIZED (SELECT g, id, x FROM ({body})),
vals AS MATERIALIZED (SELECT row_id, n, x1, x2, y FROM {rows}),
base AS (SELECT avg(abs(y - {_pred("x1", "x2")})) AS mae, sum((y - {_pred("x1", "x2")}) ** 2)
    AS sse, var_pop(y) * count(*) AS spread FROM vals, model)"""


_FIXED_CTE = REG_CTE + """,
model AS (SELECT 0.2::DOUBLE AS b0, 0.95::DOUBLE AS b1, -0.4::DOUBLE AS b2)"""
#: A model fitted to the earlier rows, explained on the later ones.
_FITTED_CTE = REG_CTE + f""",
early AS (SELECT * FROM reg WHERE row_id < floor(n * (1 - 0.2::DOUBLE))),
late AS MATERIALIZED (SELECT * REPLACE (row_number() OVER (ORDER BY row_id) - 1 AS row_id,
  count(*) OVER () AS n) FROM reg WHERE row_id >= floor(n * (1 - 0.2::DOUBLE))),
fit AS (SELECT {_FIT} FROM early, (SELECT 0 AS g) GROUP BY g), model AS MATERIALIZED (SELECT b0, b1, b2 FROM ({_COEF}))"""
_IMPORTANCE = f""",
other AS (SELECT g, t.y, t.x1, t.x2, o.x1 AS o1, o.x2 AS o2 FROM vals t
  JOIN perm p ON p.id = t.row_id JOIN vals o ON o.row_id = p.x),
raw AS (SELECT 'price' AS feature, g, (sum((y - {_pred("o1", "x2")}) ** 2) - any_value(sse))
    / any_value(spread) AS importance FROM other, base, model GROUP BY g
  UNION ALL SELECT 'discount', g, (sum((y - {_pred("x1", "o2")}) ** 2) - any_value(sse))
    / any_value(spread) FROM other, base, model GROUP BY g),
summary AS (SELECT feature, avg(importance) AS mean_importance,
  stddev_pop(importance) AS std_importance FROM raw GROUP BY feature)"""
_DECOMPOSED = f""",
places AS (SELECT g, t.row_id, t.y, t.x1, t.x2, (t.row_id // 64) * 64 + (t.row_id % 64 + 1)
    % least(64, t.n - (t.row_id // 64) * 64) AS next FROM vals t, range(REPEATS) r(g)),
other AS (SELECT s.g, s.y, s.x1, s.x2, o.x1 AS o1, u.x2 AS o2 FROM places s
  JOIN perm p ON p.g = s.g AND p.id = s.row_id JOIN vals o ON o.row_id = p.x
  JOIN perm q ON q.g = s.g AND q.id = s.next JOIN vals u ON u.row_id = q.x),
raw AS (SELECT 'price' AS feature, g, any_value(mae) AS mae,
    avg(abs(y - {_pred("o1", "x2")})) AS w, avg(abs(y - {_pred("x1", "o2")})) AS o
    FROM other, base, model GROUP BY g
  UNION ALL SELECT 'discount', g, any_value(mae), avg(abs(y - {_pred("x1", "o2")})),
    avg(abs(y - {_pred("o1", "x2")})) FROM other, base, model GROUP BY g),
parts AS (SELECT feature, mae, w - mae AS total, abs(mae - o) AS power,
  greatest(0, (w - mae) - abs(mae - o)) AS interaction FROM raw)"""
_PERM_CTE = f"{_FIXED_CTE}, {_perm_cte(REPEATS, 'reg')}"
_PERM_FITTED_CTE = f"{_FITTED_CTE}, {_perm_cte(PERMUTATION_REPEATS, 'late')}"


def _importance(spark, sf):
    rows = ordered.row_index(regression_table(spark, sf), LINE_ORDER)
    return explain.importance_summary(explain.permutation_importance(
        rows, X, "y", _fixed, "Linear", repeats=REPEATS))


def _explained(spark, sf):
    """(fitted model, numbered later rows)."""
    rows = ordered.temporal_split(regression_table(spark, sf), LINE_ORDER)
    model = train.Fitted("LinearRegression", X, train.fit_linear(
        rows.where("split = 'train'"), X, "y"))
    return model, ordered.row_index(rows.where("split = 'test'"), LINE_ORDER)


def _importance_columns(out):
    return out.select("model", "feature", r6("mean_importance", digits=5),
                      r6("std_importance", digits=5), "significant", "rank")


def _importance_sql(model):
    return f"""
SELECT '{model}' AS model, feature, {_r(["mean_importance", "std_importance"], 5)},
  mean_importance > 0 AS significant,
  row_number() OVER (ORDER BY mean_importance DESC)::INT AS rank FROM summary"""


@query("m14_permutation_importance", with_(_PERM_CTE + _IMPORTANCE, _importance_sql("Linear")))
def m14(spark, sf):
    return _importance_columns(_importance(spark, sf))


@query("m14_fitted_fifty_repeats", with_(_PERM_FITTED_CTE + _IMPORTANCE,
                                         _importance_sql("LinearRegression")))
def m14_fitted(spark, sf):
    model, rows = _explained(spark, sf)
    return _importance_columns(explain.importance_summary(explain.permutation_importance(
        rows, X, "y", model.predict, model.name)))


@query("w06_feature_rank", with_(_PERM_CTE + _IMPORTANCE, """
SELECT feature, row_number() OVER (ORDER BY mean_importance DESC)::INT AS rank FROM summary"""))
def w06(spark, sf):
    return _importance(spark, sf).select("feature", "rank")


@query("o04_top_feature", with_(_PERM_CTE + _IMPORTANCE, f"""
SELECT 'Linear' AS model, feature, {sql_r6("mean_importance", None, 5)} FROM summary
ORDER BY mean_importance DESC LIMIT 1"""))
def o04(spark, sf):
    top = explain.top_feature(_importance(spark, sf))
    return top.select("model", "feature", r6("mean_importance", digits=5))


@query("m16_importance_matrix", with_(_PERM_CTE + _IMPORTANCE, f"""
SELECT feature, {sql_r6("mean_importance", "Linear", 5)}, 0.0::DOUBLE AS Forest FROM summary"""))
def m16(spark, sf):
    out = explain.importance_matrix(_importance(spark, sf), ["Linear", "Forest"])
    return out.select("feature", r6("Linear", digits=5), r6("Forest", digits=5))


def _decomposition_sql(model):
    return f"""
SELECT '{model}' AS model, feature, {", ".join(
    f"round({sql_half_even(f'{f}({c})', 6)}, 5) + 0 AS {n}_{m}"
    for n, c in (("total_importance", "total"), ("feature_power", "power"),
                 ("interaction_power", "interaction"))
    for m, f in (("mean", "avg"), ("std", "stddev_pop")))},
  round(avg(power) / greatest(avg(total), 1e-10), 3) + 0 AS feature_power_ratio,
  round(any_value(mae), 4) + 0 AS base_mae FROM parts GROUP BY feature"""


def _decomposition_columns(out):
    means = [c for c in out.columns if c.endswith(("_mean", "_std"))]
    return out.select("model", "feature", *[r6(c, digits=5) for c in means],
                      r6("feature_power_ratio", digits=3), r6("base_mae", digits=4))


@query("m15_feature_power", with_(
    _PERM_CTE + _DECOMPOSED.replace("REPEATS", str(REPEATS)), _decomposition_sql("Linear")))
def m15(spark, sf):
    rows = ordered.row_index(regression_table(spark, sf), LINE_ORDER)
    return _decomposition_columns(explain.decomposition_summary(explain.decompose_features(
        rows, X, "y", _fixed, "Linear", repeats=REPEATS)))


@query("m15_fitted_fifty_repeats", with_(
    _PERM_FITTED_CTE + _DECOMPOSED.replace("REPEATS", str(PERMUTATION_REPEATS)),
    _decomposition_sql("LinearRegression")))
def m15_fitted(spark, sf):
    model, rows = _explained(spark, sf)
    return _decomposition_columns(explain.decomposition_summary(explain.decompose_features(
        rows, X, "y", model.predict, model.name)))


# --- two samples -------------------------------------------------------------------------

SAMPLES_CTE = """samples AS (
  SELECT 'click vs others' AS feature, CASE event_type WHEN 'click' THEN 'emulated' ELSE 'real' END
    AS side, value FROM events
  UNION ALL SELECT 'price A vs others', CASE l_returnflag WHEN 'A' THEN 'emulated' ELSE 'real' END,
    l_extendedprice FROM lineitem
  UNION ALL SELECT 'quantity vs size', 'emulated', l_quantity FROM lineitem
  UNION ALL SELECT 'quantity vs size', 'real', p_size::DOUBLE FROM part),
counts AS (SELECT feature, value, count(*) FILTER (WHERE side = 'emulated') AS c0,
  count(*) FILTER (WHERE side = 'real') AS c1 FROM samples GROUP BY feature, value),
cum AS (SELECT feature, value, sum(c0) OVER w AS k0, sum(c1) OVER w AS k1,
    sum(c0) OVER (PARTITION BY feature) AS n0, sum(c1) OVER (PARTITION BY feature) AS n1
  FROM counts WINDOW w AS (PARTITION BY feature ORDER BY value
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ks AS (SELECT feature, max(abs(k0 / n0::DOUBLE - k1 / n1::DOUBLE)) AS d, max(n0)::BIGINT AS n0,
  max(n1)::BIGINT AS n1 FROM cum GROUP BY feature)"""


def samples(spark, sf):
    events, lines, part = (table(spark, sf, t) for t in ("events", "lineitem", "part"))
    def one(df, feature, left, value):
        return df.select(F.lit(feature).alias("feature"), F.when(left, "emulated").otherwise("real")
                         .alias("side"), F.col(value).cast("double").alias("value"))
    return clean.union_by_name(
        one(events, "click vs others", F.col("event_type") == "click", "value"),
        one(lines, "price A vs others", F.col("l_returnflag") == "A", "l_extendedprice"),
        one(lines, "quantity vs size", F.lit(True), "l_quantity"),
        one(part, "quantity vs size", F.lit(False), "p_size"))


@query("m05_two_sample_ks", with_(SAMPLES_CTE, f"""
SELECT feature, n0, n1, {sql_r6("d", "ks_statistic")} FROM ks"""))
def m05(spark, sf):
    return show(distribution.two_sample_ks(samples(spark, sf)))


@query("w07_empirical_cdf", with_(SAMPLES_CTE, f"""
SELECT feature, {_r(["value"])}, k0::BIGINT AS cum_n0, k1::BIGINT AS cum_n1 FROM cum"""))
def w07(spark, sf):
    return distribution.ks_table(samples(spark, sf)).select(
        "feature", r6("value"), "cum_n0", "cum_n1")


_LIMIT_KS = ("CASE WHEN z < 0.2 THEN 1 ELSE least(1, greatest(0, 2 * list_sum(list_transform("
             "range(1, 60), lambda k: (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END)"
             " * exp(-2 * k * k * z * z))))) END")
_FAR_KS = "abs((i - 1) * m - (t + 1 - (i - 1)) * s) >= bound"
_VALIDATE_CTE = "RECURSIVE " + SAMPLES_CTE + f""",
sided AS (SELECT feature, side, count(*) AS n, avg(value) AS mean, stddev_pop(value) AS std,
  median(value) AS median, min(value) AS lo, max(value) AS hi FROM samples GROUP BY ALL),
paired AS MATERIALIZED (SELECT e.feature, e.n AS en, r.n AS rn, e.mean AS em, r.mean AS rm,
  e.std AS es, r.std AS rs, e.median AS emd, r.median AS rmd, e.lo AS elo, r.lo AS rlo,
  e.hi AS ehi, r.hi AS rhi, abs(e.mean - r.mean) / abs(r.mean) * 100 AS pct, d,
  sqrt(round(e.n::DOUBLE * r.n / (e.n + r.n))) AS root
  FROM sided e JOIN sided r ON e.feature = r.feature AND e.side = 'emulated' AND r.side = 'real'
  JOIN ks ON ks.feature = e.feature),
walk(feature, s, m, bound, t, p, killed) AS (
  SELECT feature, least(en, rn), greatest(en, rn), round(d * en * rn)::BIGINT, 0::BIGINT,
    list_transform(range(least(en, rn) + 1), lambda i: CASE WHEN i = 0 THEN 1.0::DOUBLE ELSE 0.0 END),
    0.0::DOUBLE FROM paired WHERE greatest(en, rn) <= 10000
  UNION ALL
  SELECT feature, s, m, bound, t + 1,
    list_transform(q, lambda x, i: CASE WHEN {_FAR_KS} THEN 0.0 ELSE x END),
    killed + list_sum(list_transform(q, lambda x, i: CASE WHEN {_FAR_KS} THEN x ELSE 0.0 END))
  FROM (SELECT *, list_transform(p, lambda x, i: (x * greatest(0, m - (t - (i - 1)))
      + CASE WHEN i > 1 THEN p[i - 1] * (s - (i - 2)) ELSE 0 END) / (s + m - t)) AS q
    FROM walk WHERE t < s + m)),
corrected AS (SELECT *, root * d + 1 / (6 * root) + (root * d - 1) / (4 * root * root) AS z
  FROM paired),
validated AS (SELECT corrected.*, CASE WHEN killed IS NULL THEN {_LIMIT_KS} ELSE least(1, killed) END AS p
  FROM corrected LEFT JOIN walk ON walk.feature = corrected.feature AND t = s + m)"""


@query("a15_validate_feature", with_(_VALIDATE_CTE, f"""
SELECT feature, en AS emulated_n, rn AS real_n, {", ".join(
    f"{sql_half_even(x, 2)} + 0 AS {n}" for n, x in (
        ("emulated_mean", "em"), ("real_mean", "rm"), ("emulated_std", "es"), ("real_std", "rs"),
        ("emulated_median", "emd"), ("real_median", "rmd"), ("emulated_min", "elo"),
        ("real_min", "rlo"), ("emulated_max", "ehi"), ("real_max", "rhi"),
        ("pct_difference", "pct")))},
  pct <= 20 AS within_tolerance, {sql_half_even("d", 4)} AS ks_statistic,
  {sql_half_even("p", 6)} AS ks_p_value, p < 0.05 AS ks_significant,
  CASE WHEN d < 0.1 THEN 'Very Similar distributions' WHEN d < 0.3
    THEN 'Moderately Similar distributions' ELSE 'Substantially different distributions' END
    AS ks_result FROM validated"""))
def a15(spark, sf):
    return show(compare.validate_samples(samples(spark, sf), by=("feature",)))


@query("a16_validation_totals", with_(_VALIDATE_CTE, """
SELECT dataset, count(*) AS total, count(*) FILTER (WHERE pct <= 20) AS passed,
  count(*) FILTER (WHERE p >= 0.05) AS ks_similar FROM (
  SELECT *, CASE WHEN feature = 'click vs others' THEN 'events' ELSE 'lines' END AS dataset
  FROM validated) GROUP BY ROLLUP (dataset)"""))
def a16(spark, sf):
    results = compare.validate_samples(samples(spark, sf), by=("feature",))
    tagged = results.withColumn("dataset", F.when(
        F.col("feature") == "click vs others", "events").otherwise("lines"))
    return compare.validation_totals(tagged)


@query("a17_shared_density", with_(SAMPLES_CTE + """,
e AS (SELECT feature, quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi
  FROM samples GROUP BY feature),
placed AS (SELECT s.feature, side,
    least(floor((value - lo) / ((hi - lo) / 49)), 48)::INT AS bin, count(*) AS n
  FROM samples s JOIN e ON e.feature = s.feature WHERE value BETWEEN lo AND hi
  GROUP BY s.feature, side, 3),
listed AS (SELECT f.feature, f.side, lo, hi, i::INT AS bin, coalesce(n, 0)::BIGINT AS n
  FROM (SELECT DISTINCT feature, side FROM samples) f JOIN e ON e.feature = f.feature
  CROSS JOIN range(49) r(i)
  LEFT JOIN placed p ON p.feature = f.feature AND p.side = f.side AND p.bin = i)""", """
SELECT feature, side, bin, round(lo + (hi - lo) / 49 * bin, 6) + 0 AS bin_low, n,
  round(n / (sum(n) OVER (PARTITION BY feature, side) * ((hi - lo) / 49)), 9) + 0 AS density
FROM listed"""))
def a17(spark, sf):
    out = distribution.shared_density(samples(spark, sf))
    return out.select("feature", "side", "bin", r6("bin_low"), "n", r6("density", digits=9))


@query("u02_pooled_samples", """
SELECT side, count(*) AS n, round(sum(value), 4) + 0 AS total FROM (
  SELECT 'emulated' AS side, value FROM events
  UNION ALL SELECT 'real', l_quantity FROM lineitem) GROUP BY side""")
def u02(spark, sf):
    pooled = clean.pool(table(spark, sf, "events").select("value"),
                        table(spark, sf, "lineitem").select(F.col("l_quantity").alias("value")),
                        "value")
    return pooled.groupBy("side").agg(F.count(F.lit(1)).alias("n"), r6(F.sum("value"), "total", 4))


@query("u03_append_results", with_(_VALIDATE_CTE, f"""
SELECT feature, {sql_half_even("pct", 2)} + 0 AS pct_difference FROM validated"""))
def u03(spark, sf):
    rows = samples(spark, sf)
    names = ["click vs others", "price A vs others", "quantity vs size"]
    parts = [compare.validate_samples(rows.where(F.col("feature") == n), by=("feature",))
             for n in names]
    return show(clean.union_by_name(*parts).select("feature", "pct_difference"))


@query("s13_summary_report", with_(_GAP_CTE, """
SELECT 1 AS section, model AS pos, format('{}  Train R2={:.5f}  Test R2={:.5f}  Gap={:.3f}%  [{}]',
  model, round_even(ar2 * 1e5, 0) / 1e5, round_even(br2 * 1e5, 0) / 1e5,
  round_even((ar2 - br2) * 1e5, 0) / 1e3,
  CASE WHEN ar2 - br2 < 0.01 THEN 'NO OVERFITTING' WHEN ar2 - br2 < 0.05 THEN 'MILD OVERFITTING'
  ELSE 'OVERFITTING CONCERN' END) AS line FROM gap
UNION ALL SELECT 6, '', CASE WHEN bool_or(ar2 - br2 >= 0.05)
  THEN 'WARNING: One or more models show signs of overfitting.'
  ELSE 'No evidence of overfitting detected.' END FROM gap"""))
def s13(spark, sf):
    gaps = evaluate.train_test_gap(_split_predictions(spark, sf))
    none = spark.createDataFrame([], "model string, cv_mean_r2 double, cv_std_r2 double, "
                                     "verdict string")
    untested = spark.createDataFrame([], "model string, shapiro_p double, skewness double, "
                                         "kurtosis double, is_normal boolean")
    return store.summary_report(gaps, none, None, untested)
