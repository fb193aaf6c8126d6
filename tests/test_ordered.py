"""Order, quantiles and two-sample statistics against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattloom.operators import distribution, ordered, selection


def numbers(spark, n, hot=0.34, parts=7):
    """n rows; about a third share one leading value."""
    return spark.range(n).select(
        F.when(F.col("id") % 100 < int(hot * 100), 5).otherwise(F.col("id") % 17).alias("t"),
        "id").repartition(parts)


@pytest.mark.parametrize("n,parts", [(0, 2), (1, 3), (7, 1), (503, 7)])
def test_row_index_is_dense_and_ordered(spark, n, parts):
    rows = ordered.row_index(numbers(spark, n, parts=parts), ["t", "id"]).collect()
    rows.sort(key=lambda r: (r["t"], r["id"]))
    assert [r["row_id"] for r in rows] == list(range(n))


@pytest.mark.parametrize("n", [0, 1, 4, 5, 503])
def test_folds_and_split(spark, n):
    df = numbers(spark, n)
    expected = [n // 5 + (1 if i < n % 5 else 0) for i in range(5)]
    rows = sorted(ordered.contiguous_folds(df, ["t", "id"]).collect(),
                  key=lambda r: (r["t"], r["id"]))
    want = [f for f, k in enumerate(expected) for _ in range(k)]
    if n >= 5:
        assert [r["fold"] for r in rows] == want
    tagged = sorted(ordered.temporal_split(df, ["t", "id"]).collect(),
                    key=lambda r: (r["t"], r["id"]))
    cut = int(n * 0.8)
    assert [r["split"] for r in tagged] == ["train"] * cut + ["test"] * (n - cut)


def test_prefixes(spark):
    df = numbers(spark, 101)
    for f in (0.0, 0.1, 0.55, 1.0):
        assert ordered.prefix_rows(df, ["t", "id"], f).count() == int(101 * f)


@pytest.mark.parametrize("most", [500, 60, 2])
def test_exact_quantiles(spark, most):
    rng = np.random.default_rng(1)
    data = {"a": rng.exponential(3, 400), "b": np.repeat([1.0, 2.0], [300, 1]),
            "c": np.array([4.0])}
    df = spark.createDataFrame([(g, float(v)) for g, vs in data.items() for v in vs],
                               "g string, v double")
    shares = {"q1": 0.25, "q2": 0.5, "q9": 0.99}
    table = distribution.cumulative_counts(
        distribution.value_counts(df, ["g"], "v"), ["g"], ["n"], most)
    got = table.groupBy("g").agg(*[distribution.quantile_at(s).alias(k)
                                   for k, s in shares.items()]).collect()
    for r in got:
        for k, s in shares.items():
            assert r[k] == pytest.approx(np.quantile(data[r["g"]], s), rel=1e-12)


def ks_brute(a, b):
    values = np.concatenate([a, b])
    fa = np.searchsorted(np.sort(a), values, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), values, side="right") / len(b)
    return np.abs(fa - fb).max()


@pytest.mark.parametrize("a,b", [
    ([1, 1, 1, 2], [1, 2, 2, 2]), ([1, 2, 3], [10, 11]), ([5.0] * 50, [5.0] * 3)])
def test_two_sample_ks(spark, a, b):
    df = spark.createDataFrame([("f", "emulated", float(v)) for v in a]
                               + [("f", "real", float(v)) for v in b],
                               "feature string, side string, value double")
    row = distribution.two_sample_ks(df).first()
    assert (row["n0"], row["n1"]) == (len(a), len(b))
    assert row["ks_statistic"] == pytest.approx(ks_brute(np.array(a, float), np.array(b, float)))


def test_histogram_lists_empty_bins(spark):
    values = [0.0, 0.1, 9.9, 10.0, 10.0]
    df = spark.createDataFrame([("x", v) for v in values] + [("one", 3.0)], "g string, v double")
    rows = distribution.equal_width_histogram(df, ["g"], "v", 5).orderBy("g", "bin").collect()
    assert [r["n"] for r in rows if r["g"] == "x"] == list(np.histogram(values, 5)[0])
    assert sum(r["n"] for r in rows if r["g"] == "one") == 1


def sizes(df, tag):
    return {r[tag]: r["count"] for r in df.groupBy(tag).count().collect()}


@pytest.mark.parametrize("inside,accuracy", [(20_000, 10_000), (30, 16)])
def test_exact_selection_on_any_types(spark, monkeypatch, inside, accuracy):
    """Splits in the order of Spark's own sort, with few rows ordered and poor sketches."""
    monkeypatch.setattr(selection, "INSIDE", inside)
    monkeypatch.setattr(selection, "ACCURACY", accuracy)
    df = spark.range(400).select(
        F.expr("CASE WHEN id % 7 = 0 THEN NULL WHEN id % 5 = 0 THEN 'tie' "
               "ELSE concat('key ', id % 40, 'ü') END").alias("s"),
        F.expr("CASE WHEN id % 11 = 0 THEN double('nan') WHEN id % 13 = 0 THEN NULL "
               "ELSE (id * 7919 % 101) / 7.0 END").alias("d"),
        F.expr("timestamp_ntz'2024-01-01' + make_interval(0,0,0,0,0,0, id * 37 % 50)").alias("t"),
        F.expr("id * 1152921504606846 - 9223372036854775807").alias("big"), "id").repartition(5)
    for order in (["s", "d", "id"], ["d", "t", "id"], ["t", "big"], ["big"]):
        listed = [r["id"] for r in df.orderBy(*order).select("id").collect()]
        tagged = {r["id"]: r["fold"] for r in ordered.contiguous_folds(df, order, 3).collect()}
        assert [tagged[i] for i in listed] == [0] * 134 + [1] * 133 + [2] * 133, order


@pytest.mark.parametrize("inside", [20_000, 40])
def test_sizes_are_exact_on_ties(spark, monkeypatch, inside):
    monkeypatch.setattr(selection, "INSIDE", inside)
    rows = [(1, "a", i % 4) for i in range(200)] + [(2, "same", 0)] * 300 + [(3, "z", 1)] * 3
    df = spark.createDataFrame(rows, "day int, x string, y int").repartition(4)
    split = ordered.temporal_split(df, ["day"])
    assert sizes(split, "split") == {"train": 402, "test": 101}
    assert split.where("split = 'train' AND day = 3").count() == 0
    assert sorted(map(tuple, split.drop("split").collect())) == sorted(rows)  # no row changes
    folds = ordered.contiguous_folds(df, ["day"])
    assert sizes(folds, "fold") == {0: 101, 1: 101, 2: 101, 3: 100, 4: 100}
    tagged, planned = ordered.prefix_rank(df, ["day"], [0.1, 0.55, 1.0])
    found = sizes(tagged, "prefix")
    assert planned == [50, 276, 503] and [found[0], found[0] + found[1]] == [50, 276]


def test_sizes_by_date_alone_without_a_shuffle_of_the_rows(spark):
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    by_day = orders.withColumn("day", F.date_trunc("month", "o_orderdate"))
    tagged = ordered.contiguous_folds(by_day, ["day"])
    assert sizes(tagged, "fold") == {i: 3000 for i in range(5)}
    bounds = tagged.groupBy("fold").agg(F.min("day").alias("a"), F.max("day").alias("b")).orderBy(
        "fold").collect()
    assert all(x["b"] <= y["a"] for x, y in zip(bounds, bounds[1:]))
    plan = tagged._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan and "Sort" not in plan


def test_many_groups_and_chunks(spark):
    """100,000 groups beside one group of 10,000 chunks and more."""
    small = spark.range(300_000).select((F.col("id") % 100_000).alias("g"),
                                        (F.col("id") / 7).alias("v"))
    large = spark.range(60_000).select(F.lit(-1).cast("long").alias("g"),
                                       F.exp(F.col("id") / 10_000).alias("v"))
    counted = distribution.value_counts(small.unionAll(large), ["g"], "v")
    rows = distribution.chunked(counted, ["g"], 6)
    sizes = rows.groupBy("g", "_chunk").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("a"),
                                            F.max("value").alias("b"))
    assert sizes.where("n > 6").isEmpty()
    listed = sizes.where("g = -1").orderBy("_chunk").collect()
    assert len(listed) >= 10_000 and all(x["b"] < y["a"] for x, y in zip(listed, listed[1:]))
    table = distribution.cumulative_counts(counted, ["g"], ["n"], 6)
    got = table.where("g IN (-1, 5)").groupBy("g").agg(
        distribution.quantile_at(0.5).alias("m"), F.max("cum_n").alias("n")).collect()
    want = {-1: (np.median(np.exp(np.arange(60_000) / 10_000)), 60_000), 5: (100_005 / 7, 3)}
    assert {r["g"]: (pytest.approx(r["m"]), r["n"]) for r in got} == want


def test_density_of_constant_features_and_empty_bins(spark):
    rows = [("c", s, 3.0) for s in ("emulated", "real")] * 4
    rows += [("x", "emulated", float(v)) for v in (0, 1, 10)] + [("x", "real", 5.0)]
    got = distribution.shared_density(
        spark.createDataFrame(rows, "feature string, side string, value double"), edges=6)
    by = {}
    for r in got.collect():
        by.setdefault((r["feature"], r["side"]), {})[r["bin"]] = (r["n"], r["density"])
    assert all(len(bins) == 5 for bins in by.values()) and len(by) == 4
    assert by["c", "real"][0] == (4, None) and by["c", "real"][4] == (0, None)
    assert sum(n for n, _ in by["x", "real"].values()) == 1 and by["x", "real"][0] == (0, 0.0)
