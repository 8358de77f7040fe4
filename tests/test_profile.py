import random

import pytest
from conftest import rows

from matchspark.operators import profile
from matchspark.operators.quantiles import exact_percentiles
from matchspark.operators.select import FeatureSelection, correlated_columns, upper_correlations, varying_columns


def brute_percentile(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    low = int(at)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (at - low)


@pytest.mark.parametrize("kind", ["few", "spread", "heavy", "one", "pair"])
@pytest.mark.parametrize(("accuracy", "ranked_rows"), [(10_000, 1_000_000), (10_000, 40), (20, 200)])
def test_percentiles_are_exact(spark, kind, accuracy, ranked_rows):
    rnd = random.Random(7)
    values = {
        "few": [float(rnd.randint(-3, 3)) for _ in range(500)],
        "spread": [rnd.lognormvariate(0, 5) for _ in range(3001)],
        # a third of the rows share one value
        "heavy": [rnd.random() for _ in range(1000)] + [0.5] * 500,
        "one": [4.0],
        "pair": [1.0, 2.0],
    }[kind]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    wanted = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    found = exact_percentiles(df, "v", wanted, accuracy, ranked_rows)
    for p in wanted:
        assert found[p] == pytest.approx(brute_percentile(values, p), rel=1e-12)


def test_percentiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert exact_percentiles(df, "v", [0.5]) == {0.5: None}
    described = profile.describe_column(df, "v").first()
    assert described["n"] == 0 and described["p50"] is None


def test_approximate_description_has_the_same_columns(spark):
    df = spark.range(100).selectExpr("cast(id as double) as v")
    assert profile.describe_column(df, "v", approximate=True).columns == profile.describe_column(df, "v").columns


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 0, 1, 30, 31, 31]] + [(None,)], "v double")
    out = {r["bin"]: r for r in profile.histogram(df, "v").collect()}
    assert len(out) == 31 and out[1]["n"] == 2 and out[2]["n"] == 1 and out[31]["n"] == 3
    assert out[31]["bin_high"] == 31.0 and sum(r["n"] for r in out.values()) == 6


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    out = profile.histogram(df, "v").collect()
    assert min(r["bin_low"] for r in out) == 2.5 and max(r["bin_high"] for r in out) == 3.5
    assert sum(r["n"] for r in out) == 2
    assert profile.histogram(df.limit(0), "v").count() == 0


def test_constant_columns(spark):
    df = spark.createDataFrame(
        [(1, "a", None, 1.0, None, 0.0), (2, "a", None, None, "x", -0.0)],
        "ID int, same string, none string, half double, gap string, zero double",
    )
    out = dict(rows(profile.constant_columns(df)))
    assert out == {"same": True, "none": True, "half": False, "gap": False, "zero": True}
    train, test = profile.drop_constant(df, df.drop("same"))
    assert train.columns == test.columns == ["ID", "half", "gap"]


def test_missing_and_overview(spark):
    df = spark.createDataFrame([(1, None, "t"), (2, 2.0, "u")], "ID int, x double, t string")
    assert rows(profile.top_missing(df)) == [("x", 0.5)]
    assert tuple(profile.columns_with_missing(df).first()) == (1, 2)
    assert rows(profile.feature_type_counts({"d": df})) == [("d", 2, 1, 1)]
    assert rows(profile.distinct_counts(df, ["x", "t"])) == [("t", 2), ("x", 1)]
    assert rows(profile.distinct_counts(df, ["x", "t"], exact=False)) == [("t", 2), ("x", 1)]
    assert profile.preview(df, 1).count() == 1


def test_variance_extremes_put_undefined_last(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0, None), (2, 3.0, 5.0, 1.0)], "ID int, a double, b double, c double")
    out = rows(profile.variance_extremes(df, k=2))
    assert out == [("a", 2.0, "top"), ("b", 0.0, "bottom"), ("b", 0.0, "top"), ("c", None, "bottom")] or sorted(
        out, key=str
    ) == sorted([("a", 2.0, "top"), ("b", 0.0, "top"), ("b", 0.0, "bottom"), ("c", None, "bottom")], key=str)


def test_wide_measures_equal_narrow_ones(spark):
    n = 50
    rnd = random.Random(3)
    data = [(i, *[None if rnd.random() < 0.2 else rnd.random() for _ in range(n)]) for i in range(40)]
    df = spark.createDataFrame(data, "ID int, " + ", ".join(f"c{i} double" for i in range(n)))
    names = [f"c{i}" for i in range(n)]
    measures = {"v": "var_samp({})", "n": "count({})"}
    narrow = rows(profile.column_measures(df, names, measures, aggregates=1000))
    wide = rows(profile.column_measures(df, names, measures, aggregates=14))
    assert [r[0] for r in narrow] == [r[0] for r in wide] and len(wide) == n
    for a, b in zip(narrow, wide):
        assert a[1] == pytest.approx(b[1]) and a[2] == b[2]


def test_correlation_deletes_pairwise_and_survives_constants(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 1.0, 4.0, 1, 0, 0), (2, 2.0, None, 4.0, 0, 1, 0), (3, 3.0, 5.0, 4.0, 0, 1, 0), (4, 4.0, 2.0, 4.0, 0, 0, 1)],
        "ID int, a double, gap double, same double, HOME_WINS int, DRAW int, AWAY_WINS int",
    )
    out = {(f, t): r for f, t, r in rows(profile.target_correlations(df))}
    assert out[("same", "DRAW")] is None
    # without the row whose value is missing: (1,0), (5,1), (2,0)
    x, y = [1.0, 5.0, 2.0], [0.0, 1.0, 0.0]
    mx, my = sum(x) / 3, sum(y) / 3
    r = sum((a - mx) * (b - my) for a, b in zip(x, y)) / (
        sum((a - mx) ** 2 for a in x) * sum((b - my) ** 2 for b in y)
    ) ** 0.5
    assert out[("gap", "DRAW")] == pytest.approx(abs(r))
    top = profile.top_target_correlations(df, k=1)
    assert top.count() == 3 and top.where("feature = 'same'").count() == 0


def test_shapes_skip_absent_tables(spark):
    df = spark.createDataFrame([(1, 2)], "ID int, x int")
    assert rows(profile.shape_summary({"a": df, "b": None})) == [("a", 1, 2)]


def test_correlated_chain(spark):
    rnd = random.Random(5)
    data = []
    for i in range(300):
        a = rnd.random()
        b = a + rnd.random() * 0.05
        data.append((i, a, b, b + rnd.random() * 0.05, rnd.random(), 7.0))
    df = spark.createDataFrame(data, "ID int, a double, b double, c double, free double, same double")
    assert correlated_columns(df) == ["b", "c"]
    pairs = {(x, y): r for x, y, r in rows(upper_correlations(df))}
    assert len(pairs) == 10 and pairs[("a", "same")] is None


def test_variance_threshold_uses_the_population(spark):
    # population variance 2.25e-4, sample variance 4.5e-4
    df = spark.createDataFrame([(1, 0.00, 0.0), (2, 0.03, 1.0)], "ID int, edge double, wide double")
    assert varying_columns(df, threshold=3e-4) == ["wide"]
    assert varying_columns(df, threshold=2e-4) == ["edge", "wide"]
    with pytest.raises(ValueError):
        varying_columns(df, threshold=10.0)
    chosen = FeatureSelection.fit(df, max_correlation=0.995)
    assert (chosen.dropped, chosen.features) == (("wide",), ("edge",))
