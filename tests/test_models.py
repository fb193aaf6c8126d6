"""Statistics, models and explanation on small fixtures."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattloom.functions import pvalues
from wattloom.operators import compare, evaluate, explain, mlp, ordered, permutation, split, train
from wattloom.session import work_path


def design(spark, n=400, noise=0.1):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, 2))
    y = 2 * x[:, 0] - x[:, 1] + 0.5 + noise * rng.normal(size=n)
    return spark.createDataFrame(
        [(i, float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y))],
        "row_id long, a double, b double, y double").repartition(5), x, y


def test_tail_probabilities():
    # Table values of the t distribution and of the limiting KS distribution.
    assert pvalues.t_two_sided(2.228, 10) == pytest.approx(0.05, abs=1e-4)
    assert pvalues.t_two_sided(1.96, 1e6) == pytest.approx(0.05, abs=1e-4)
    assert pvalues.t_upper(-1.0, 5) + pvalues.t_upper(1.0, 5) == pytest.approx(1.0)
    assert pvalues.t_two_sided(math.inf, 3) == 0.0 and pvalues.t_two_sided(None, 3) is None
    n = 10 ** 6
    assert pvalues.ks_two_sided(1.358 * math.sqrt(2 / n), n, n) == pytest.approx(0.05, abs=1e-3)
    for z in (0.5, 0.9999, 1.0001):  # both series agree where they meet
        d = z * math.sqrt(2 / n)
        direct = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * z * z) for k in range(1, 100))
        assert pvalues.ks_limit(d * math.sqrt(n / 2)) == pytest.approx(direct, abs=1e-9)


def test_shapiro_wilk():
    # The published example of eleven weights: W = 0.79, p below 0.01.
    weights = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]
    w, p = pvalues.shapiro_wilk(np.array(weights, float))
    assert w == pytest.approx(0.79, abs=0.005) and 0.004 < p < 0.01
    rng = np.random.default_rng(0)
    assert pvalues.shapiro_wilk(rng.normal(size=3000))[1] > 0.01
    assert pvalues.shapiro_wilk(rng.exponential(size=3000))[1] < 1e-10
    assert pvalues.shapiro_wilk(np.ones(2)) == (None, None)


def test_scaler_constant_feature_and_refit(spark):
    df = spark.createDataFrame([(i, float(i), 7.0, 1.0) for i in range(10)],
                               "t int, x double, c double, y double")
    rows, params = split.prepare_split(df, ["x", "c"], "y", ["t"])
    p = {r["feature"]: (r["mean"], r["scale"]) for r in params.collect()}
    assert p["c"] == (7.0, 1.0) and p["x"] == pytest.approx((3.5, np.std(range(8))))
    assert rows.where("c <> 0").count() == 0
    own, _ = split.prepare_split(df, ["x", "c"], "y", ["t"], test_scaler="refit")
    assert own.where("split = 'test'").agg(F.avg("x")).first()[0] == pytest.approx(0.0)


def test_linear_fits_agree(spark):
    df, x, y = design(spark)
    want = np.linalg.lstsq(np.c_[x, np.ones(len(y))], y, rcond=None)[0]
    by_ml = train.fit_linear(df, ["a", "b"], "y")
    by_sums = train.segment_moments(df.withColumn("g", F.lit(0)), ["a", "b"], "y", "g")[0].ols()
    for coef, icpt in ((by_ml.coefficients, by_ml.intercept),
                       (by_sums.coefficients, by_sums.intercept)):
        assert [*coef, icpt] == pytest.approx(want.tolist(), abs=1e-8)


def test_fold_and_curve_scores_match_refits(spark):
    df, x, y = design(spark)
    tagged = ordered.contiguous_folds(df, ["row_id"])
    fast = train.linear_fold_scores(tagged, ["a", "b"], "y")
    slow = train.fold_scores(train.fit_linear, tagged, ["a", "b"], "y", "LinearRegression")
    assert [r for _, _, r in fast] == pytest.approx([r for _, _, r in slow], abs=1e-8)
    pre, sizes = ordered.prefix_rank(df, ["row_id"], [0.1, 0.5, 1.0])
    a = train.linear_learning_curve(pre, df, ["a", "b"], "y", [0.1, 0.5, 1.0])
    b = train.learning_curve(train.fit_linear, pre, df, ["a", "b"], "y", "LinearRegression",
                             [0.1, 0.5, 1.0])
    assert sizes == [40, 200, 400] and [r[2] for r in a] == sizes == [r[2] for r in b]
    assert [r[4] for r in a] == pytest.approx([r[4] for r in b], abs=1e-8)


def test_singular_design_has_small_coefficients(spark):
    df, _, _ = design(spark, noise=0.0)
    twin = df.withColumn("c", F.col("a")).withColumn("k", F.lit(1.0))
    fit = train.segment_moments(twin.withColumn("g", F.lit(0)), ["a", "b", "c", "k"], "y",
                                "g")[0].ols()
    assert fit.coefficients == pytest.approx([1.0, -1.0, 1.0, 0.0], abs=1e-6)


def test_grid_search_and_saving(spark):
    df, _, _ = design(spark)
    tagged = ordered.contiguous_folds(df, ["row_id"], 2)
    grids = {"LinearRegression": {}, "RandomForest": {"numTrees": [3], "maxDepth": [1, 4]},
             "Broken": {}, "MLPRegressor": {"hidden": [(8,)], "epochs": [3]}}
    models = train.train_all(tagged, ["a", "b"], "y", grids, folds=2)
    assert list(models) == ["LinearRegression", "RandomForest", "MLPRegressor"]
    assert models["RandomForest"].params["maxDepth"] == 4
    folder = work_path(spark, "models")
    train.save_models(spark, models, folder)
    back = train.load_models(spark, folder)
    a = evaluate.scores(train.predict_all(models, df)).orderBy("model").collect()
    b = evaluate.scores(train.predict_all(back, df)).orderBy("model").collect()
    assert [r["model"] for r in a] == [r["model"] for r in b]
    assert [r["rmse"] for r in a] == pytest.approx([r["rmse"] for r in b])
    assert train.planned_fits(train.GRIDS["RandomForest"]) == 60
    assert train.planned_fits(train.GRIDS["MLPRegressor"]) == 60


def test_best_setting_takes_the_first_of_equals():
    rows = [{"combo": c, "params": f'{{"p": {c}}}', "val_rmse": 1.0} for c in (1, 0)]
    assert train.best_setting(rows) == ({"p": 0}, 1.0)


def test_mlp_learns(spark):
    df, _, _ = design(spark, 2000)
    for activation in ("relu", "tanh"):
        net = mlp.fit(df, ["a", "b"], "y", hidden=(16,), activation=activation,
                      learningRate=0.01, epochs=12)
        scored = df.withColumn("pred_m", net.column(["a", "b"]))
        assert evaluate.scores(scored).first()["r2"] > 0.95


def test_evaluation_edges(spark):
    df = spark.createDataFrame([(i, 4.0, 4.0, 5.0) for i in range(6)],
                               "row_id long, y double, pred_a double, pred_b double")
    got = {r["model"]: r["r2"] for r in evaluate.scores(df).collect()}
    assert got == {"a": 1.0, "b": 0.0}  # constant target
    same = df.withColumn("pred_b", F.col("pred_a"))
    row = evaluate.compare_models(same).first()
    assert row["t_statistic"] is None and not row["significant"]
    assert row["better_model"] == "b"  # equal errors: the second
    assert evaluate.best_model(evaluate.evaluate(same), ["b", "a"]).first()["best_model"] == "b"


def test_bounded_sample_ignores_partitioning(spark):
    df = spark.range(9000).withColumnRenamed("id", "row_id")
    a = {r[0] for r in evaluate.bounded_sample(df.repartition(3)).collect()}
    b = {r[0] for r in evaluate.bounded_sample(df.repartition(11)).collect()}
    assert a == b and len(a) == 5000


@pytest.mark.parametrize("n", [2, 97])
def test_partners_are_permutations(spark, n):
    df = spark.range(n).select(F.col("id").alias("row_id"), F.col("id").cast("double").alias("a"),
                               (F.col("id") + 1000).cast("double").alias("b"))
    scored = df.withColumn("_base", F.lit(0.0))
    for others in (explain.paired_rows(scored, ["a", "b"], "a", n, 3),
                   explain.independent_partners(df, ["a", "b"], n, 3),
                   explain.hashed_partners(df, ["a", "b"], 3)):
        rows = others.collect()
        for r in range(3):
            mine = [x for x in rows if x["repeat"] == r]
            assert sorted(x["row_id"] for x in mine) == list(range(n))
            assert sorted(x["other"][0] for x in mine) == [float(i) for i in range(n)]
            assert sorted(x["other"][1] for x in mine) == [float(i + 1000) for i in range(n)]


def permuted(n, repeat, inverse=False):
    out = permutation._apply(np.arange(n), n, 42, repeat, inverse)
    while (out >= n).any():
        out = np.where(out < n, out, permutation._apply(out, n, 42, repeat, inverse))
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 97, 1000, 4999])
def test_keyed_permutations(spark, n):
    rows = spark.range(n).withColumn("repeat", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    there = permutation.permute(rows, "id", "at", n, 42, 3)
    back = permutation.permute(there, "at", "back", n, 42, 3, inverse=True).collect()
    assert all(r["back"] == r["id"] for r in back)
    for repeat in range(3):
        got = [r["at"] for r in sorted(back) if r["repeat"] == repeat]
        assert sorted(got) == list(range(n)) and got == permuted(n, repeat).tolist()


def test_permutations_look_random_on_periodic_data():
    n = 50_000
    for repeat in range(5):
        at = permuted(n, repeat)
        for period in (2, 7, 24, 288):
            # The share of rows whose partner has the same phase, and of phases that follow.
            same = np.mean(at % period == np.arange(n) % period)
            assert abs(same - 1 / period) < 5 * (1 / period / n) ** 0.5
        assert abs(np.corrcoef(at, np.arange(n))[0, 1]) < 0.03
        assert len(np.unique((at[1:] - at[:-1]) % n)) > n / 3
    big = (1 << 45) + 12345  # beyond any product bound of a stride
    x = np.arange(big - 1000, big)
    a, b = permutation.sides(big)
    assert 0 <= a * b - big <= a
    assert (permutation._apply(permutation._apply(x, big, 1, 0, False), big, 1, 0, True) == x).all()


@pytest.mark.parametrize("mode", ["keyed", "hash"])
def test_importance_against_brute_force(spark, mode):
    df, x, y = design(spark, 300)
    model = train.LinearFormula([2.0, 0.0], 0.5)

    def predict(rows, column):
        return rows.withColumn(column, model.column(["a", "b"]))

    raw = explain.permutation_importance(df, ["a", "b"], "y", predict, "m", repeats=4, mode=mode)
    out = {r["feature"]: r for r in explain.importance_summary(raw).collect()}
    assert out["b"]["mean_importance"] == 0.0 and out["b"]["p_value"] == 1.0
    assert out["a"]["rank"] == 1 and out["a"]["significant"]
    if mode == "keyed":
        base = ((y - 0.5 - 2 * x[:, 0]) ** 2).sum()
        drops = []
        for r in range(4):
            other = x[permuted(300, r), 0]
            drops.append((((y - 0.5 - 2 * other) ** 2).sum() - base) / (np.var(y) * 300))
        assert out["a"]["mean_importance"] == pytest.approx(np.mean(drops))
        assert out["a"]["std_importance"] == pytest.approx(np.std(drops))


def test_validation_edges(spark):
    def side(rows):
        return spark.createDataFrame(rows, "x double, z double")

    ours, real = side([(0.0, 1.0), (0.0, None)]), side([(0.0, None), (1.0, None)])
    got = compare.validate_against(ours, real, {"x": "x", "z": "z", "q": "x"}, "d").collect()
    assert [r["feature"] for r in got] == ["x vs x"]  # z has an empty side, q is missing
    assert got[0]["pct_difference"] == 100.0 and not got[0]["within_tolerance"]
    zero = side([(0.0, 0.0)])
    assert compare.validate_against(zero, zero, {"x": "x"}, "d").first()["pct_difference"] == 0.0
    assert compare.validate_against(zero, zero, {"nope": "x"}, "d") is None


def test_validation_reads_each_table_once(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch
    rng = np.random.default_rng(3)
    a, b = rng.normal(5, 2, (400, 2)).round(1), rng.normal(6, 1, (300, 2)).round(1)
    ours, theirs = (spark.createDataFrame(x.tolist(), "x double, z double")
                    .mapInArrow(seen, "x double, z double") for x in (a, b))
    got = {r["feature"]: r for r in compare.validate_against(
        ours, theirs, {"x": "x", "z": "z"}, "d").collect()}
    assert read.value == 700
    for j, c in enumerate(("x vs x", "z vs z")):
        assert (got[c]["emulated_n"], got[c]["real_n"]) == (400, 300)
        for side, x in (("emulated", a[:, j]), ("real", b[:, j])):
            want = {"mean": x.mean(), "std": x.std(), "median": np.median(x), "min": x.min(),
                    "max": x.max()}
            assert {k: got[c][f"{side}_{k}"] for k in want} == pytest.approx(want, abs=0.0051)


def test_scores_use_complete_pairs(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, None), (None, 3.0), (5.0, 4.0)],
                               "y double, pred_m double")
    row = evaluate.scores(df).first()
    assert row["n"] == 3 and row["mae"] == pytest.approx(0.5)
    assert row["r2"] == pytest.approx(1 - 1.25 / (np.var([1.0, 2.0, 5.0]) * 3))


def test_exact_ks_p_equals_enumeration():
    from itertools import combinations
    for n1, n2 in ((1, 1), (2, 3), (3, 7), (5, 5), (6, 6), (4, 8)):
        gaps = []
        for first in combinations(range(n1 + n2), n1):
            i = np.cumsum(np.isin(np.arange(n1 + n2), first))
            gaps.append(np.abs(i * n2 - (np.arange(1, n1 + n2 + 1) - i) * n1).max())
        for gap in sorted(set(gaps)):
            assert pvalues.ks_exact(gap / (n1 * n2), n1, n2) == pytest.approx(
                np.mean(np.array(gaps) >= gap))
    assert pvalues.ks_exact(0.0, 5, 5) == 1.0
    # Beyond the exact sizes the corrected limit goes on from the exact values.
    for d in (0.01, 0.02, 0.03):
        exact = pvalues.ks_exact(d, 4000, 10_000)
        root = math.sqrt(4000 * 10_000 / 14_000)
        z = root * d
        assert pvalues.ks_limit(z + 1 / (6 * root) + (z - 1) / (4 * root * root)) == pytest.approx(
            exact, abs=2e-3)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_shuffled_values_meet_rows_without_a_join(spark):
    df, _, _ = design(spark, 100)
    formula = train.LinearFormula([2.0, 0.0], 0.5)

    def predict(rows, column):
        return rows.withColumn(column, formula.column(["a", "b"]))
    for step in (explain.permutation_importance, explain.decompose_features):
        plan = _plan(step(df, ["a", "b"], "y", predict, "m", repeats=50))
        assert "FlatMapCoGroupsInArrow" in plan
        assert [word for word in ("MergeJoin", "HashJoin", "lambda") if word in plan] == []


@pytest.mark.parametrize("apart", [False, True])
def test_partners_over_several_blocks_with_nulls(spark, apart):
    n, size = 40_000, explain._block_rows(50)
    assert n > 2 * size
    df = spark.range(n).select(
        F.col("id").alias("row_id"), F.when(F.col("id") % 9 != 0, F.col("id") * 1.0).alias("a"),
        (F.col("id") + 0.5).alias("b"), F.lit(0.0).alias("_base"))
    made = (explain.independent_partners(df, ["a", "b"], n, 50) if apart else
            explain.paired_rows(df, ["a", "b"], "b", n, 50))
    rows = {r["row_id"]: r["other"] for r in made.where("repeat = 49").collect()}
    at, first = permuted(n, 49), np.arange(n) // 64 * 64
    second = at[first + (np.arange(n) % 64 + 1) % np.minimum(64, n - first)] if apart else at
    assert len(rows) == n
    for i in range(n):
        assert rows[i] == [None if at[i] % 9 == 0 else float(at[i]), second[i] + 0.5]


def test_linear_model_predicts_by_an_expression(spark):
    df, x, _ = design(spark, 50)
    model = train.Fitted("LinearRegression", ["a", "b"], train.fit_linear(df, ["a", "b"], "y"))
    out = model.predict(df, "p")
    assert "UDF" not in _plan(out) and "array_to_vector" not in _plan(out)
    want = [r["prediction"] for r in model.model.transform(
        split.with_vector(df, ["a", "b"], "_features")).orderBy("row_id").collect()]
    assert [r["p"] for r in out.orderBy("row_id").collect()] == pytest.approx(want)
