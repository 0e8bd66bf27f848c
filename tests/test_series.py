import math
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseflow.operators import series


def months(n):
    return [date(2015 + i // 12, i % 12 + 1, 1) for i in range(n)]


def frame_of(spark, table):
    rows = [(k, m, float(v)) for k, vs in table.items() for m, v in zip(months(len(vs)), vs)]
    return spark.createDataFrame(rows, "vara string, mes date, n double").repartition(3)


def test_stl_recovers_a_clean_pattern():
    n = 120
    pattern = np.sin(2 * np.pi * np.arange(12) / 12) * 5
    y = 20 + 0.3 * np.arange(n) + np.tile(pattern, 10)
    flat_seasonal, flat_trend = series.stl_periodic(y - 0.3 * np.arange(n))
    assert np.allclose(flat_seasonal, np.tile(pattern, 10)) and np.allclose(flat_trend, 20)
    # with a trend, two inner rounds come close and further ones converge
    assert np.allclose(series.stl_periodic(y)[0], np.tile(pattern, 10), atol=0.2)
    seasonal, trend = series.stl_periodic(y, inner=20)
    assert np.allclose(seasonal, np.tile(pattern, 10)) and np.allclose(trend, 20 + 0.3 * np.arange(n))


def test_stl_parts(spark):
    rng = np.random.default_rng(1)
    table = {"a": rng.poisson(20, 100), "b": rng.poisson(5, 37), "c": np.full(24, 3)}
    rows = series.decompose(frame_of(spark, table), "vara").collect()
    for key, y in table.items():
        parts = {c: np.array([r.valor for r in sorted(rows, key=lambda r: r.data) if r.vara == key and r.componente == c])
                 for c in ("observed", "trend", "seasonal", "remainder")}
        assert np.allclose(parts["observed"], y)
        assert np.allclose(parts["trend"] + parts["seasonal"] + parts["remainder"], y)
        for phase in range(12):
            assert np.ptp(parts["seasonal"][phase::12]) < 1e-9
        if key == "a":
            assert abs(parts["seasonal"][:96].mean()) < 0.5


def test_stl_needs_two_years():
    with pytest.raises(ValueError):
        series.stl_periodic(np.arange(23.0))


def test_loess_reproduces_a_quadratic_and_ignores_zero_weights(spark):
    x = np.arange(40.0)
    y = 3 - 0.2 * x + 0.05 * x ** 2
    fitted, errors = series.local_quadratic(x, y, np.ones(40), 0.5)
    assert np.allclose(fitted, y) and np.allclose(errors, 0, atol=1e-6)
    spoiled, weights = y.copy(), np.ones(40)
    spoiled[10], weights[10] = 1e6, 0
    assert np.allclose(series.local_quadratic(x, spoiled, weights, 0.5)[0], y)


def test_loess_matches_least_squares_at_each_point(spark):
    rng = np.random.default_rng(2)
    y = rng.random(30)
    rows = sorted(series.smooth(frame_of(spark, {"a": y}), "vara", "mes", "n", span=0.4, surface="direct").collect(), key=lambda r: r.data)
    x = np.array([(m - months(1)[0]).days for m in months(30)], dtype=float)
    q = int(30 * 0.4)
    for i in (0, 7, 29):
        d = np.abs(x - x[i])
        h = np.sort(d)[q - 1]
        k = np.where(d < h, (1 - (d / h) ** 3) ** 3, 0)
        fit = np.polyfit(x - x[i], y, 2, w=np.sqrt(k))
        assert rows[i].ajuste == pytest.approx(fit[-1], abs=1e-6)
        assert rows[i].erro_padrao > 0


def test_histogram(spark):
    values = np.random.default_rng(4).gamma(2, 3, 1000)
    frame = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    rows = sorted(series.histogram(frame, "x").collect(), key=lambda r: r.faixa)
    assert len(rows) == 100 and sum(r.n for r in rows) == 1000
    width = (values.max() - values.min()) / 99
    edges = values.min() - width / 2 + width * np.arange(101)
    assert [r.n for r in rows] == list(np.histogram(values, edges)[0])
    assert rows[0].centro == pytest.approx(values.min())


def test_histogram_of_one_value_and_of_nothing(spark):
    one = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert sum(r.n for r in series.histogram(one, "x", 10).collect()) == 2
    assert series.histogram(one.limit(0), "x").count() == 0


def test_density_is_close_to_the_exact_one(spark):
    values = np.random.default_rng(5).normal(10, 2, 800)
    frame = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(3)
    q1, q3 = np.quantile(values, [0.25, 0.75])
    bw = series.rule_of_thumb_bandwidth(800, values.std(ddof=1), q1, q3)
    rows = sorted(series.kernel_density(frame, "x", bw).collect(), key=lambda r: r.x)
    assert len(rows) == 512
    for r in rows[::37]:
        exact = np.exp(-((r.x - values) / bw) ** 2 / 2).sum() / (800 * bw * math.sqrt(2 * math.pi))
        assert r.densidade == pytest.approx(exact, abs=2e-4)
    area = frame.select(F.lit(0)).count() and np.trapezoid([r.densidade for r in rows], [r.x for r in rows])
    assert 0.97 < area < 1.001


@pytest.mark.parametrize("bw", [1e-4, 0.01, 3.0])
def test_density_of_narrow_and_wide_bandwidths(spark, bw):
    """Far outliers make the range long: bandwidths under a 512th of it need cells of their own size."""
    values = np.concatenate([np.random.default_rng(6).normal(0, 1, 300), [-500.0, 900.0, 0.25, 0.25]])
    frame = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double").repartition(3)
    rows = sorted(series.kernel_density(frame, "x", bw).collect(), key=lambda r: r.x)
    exact = np.array([np.exp(-((r.x - values) / bw) ** 2 / 2).sum() for r in rows]) / (len(values) * bw * math.sqrt(2 * math.pi))
    assert len(rows) == 512 and rows[0].x == -500.0
    # linear binning is off by cell^2 / 8 times the largest second derivative of the kernel, twice
    bound = (1 / 4) ** 2 / 4 * exact.max() + 1e-9 / bw
    assert np.abs(np.array([r.densidade for r in rows]) - exact).max() <= bound


def test_density_of_nothing(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    assert series.kernel_density(empty, "x", 1.0).count() == 0
    assert series.kernel_density(empty, "x", 1.0).columns == ["x", "densidade"]


def direct_operator(x, weights, span):
    """The whole smoother as an n x n matrix, from weighted least squares at every point."""
    q = max(min(int(len(x) * span + 1e-5), len(x)), 3)
    out = np.empty((len(x), len(x)))
    for i, at in enumerate(x):
        d = np.abs(x - at)
        k = np.clip(1 - (d / np.sort(d)[q - 1]) ** 3, 0, None) ** 3 * weights
        design = np.vander(x - at, 3, increasing=True)
        out[i] = np.linalg.solve((design * k[:, None]).T @ design, (design * k[:, None]).T)[0]
    return out


def test_loess_errors_match_the_whole_smoother():
    rng = np.random.default_rng(12)
    x, weights = np.sort(rng.uniform(0, 100, 80)), rng.uniform(0.5, 3, 80)
    y = np.sin(x / 15) + rng.normal(0, 0.2, 80)
    smoother = direct_operator(x, weights, 0.5)
    rest = np.eye(80) - smoother
    scale2 = np.sum(weights * (rest @ y) ** 2) / np.trace(rest @ rest.T)
    fitted, errors = series.local_quadratic(x, y, weights, 0.5)
    assert fitted == pytest.approx(smoother @ y, abs=1e-9)
    assert errors == pytest.approx(np.sqrt(scale2 * (smoother ** 2 / weights).sum(axis=1)), rel=1e-6)


@pytest.mark.parametrize("n, span", [(60, 0.75), (400, 0.3), (3, 0.75), (7, 0.9)])
def test_blended_loess(n, span):
    rng = np.random.default_rng(n)
    x = np.sort(rng.choice(np.arange(5 * n), n, replace=False)).astype(float)
    weights = rng.uniform(0.5, 2, n)
    y = np.cos(x / n) + rng.normal(0, 0.1, n)
    fitted, errors = series.blended_quadratic(x, y, weights, span)
    exact, exact_errors = series.local_quadratic(x, y, weights, span)
    borders = series.tree_vertices(x, max(int(n * span * 0.2), 1))
    assert len(borders) <= 2 + 4 / (span * 0.2) or n < 10
    # the blend passes through the fits at the vertices: move a vertex's fit to a data point and compare there
    assert np.abs(fitted - exact).max() < 0.06 * np.ptp(y) and np.isfinite(fitted).all()
    if n > 10:
        assert errors == pytest.approx(exact_errors, rel=0.35)
    shuffled = rng.permutation(n)
    again, errors_again = series.blended_quadratic(x[shuffled], y[shuffled], weights[shuffled], span)
    assert again == pytest.approx(fitted[shuffled]) and errors_again == pytest.approx(errors[shuffled], nan_ok=True)
    line = series.blended_quadratic(x, 2 - 0.5 * x, weights, span)
    assert n == 3 or line[0] == pytest.approx(2 - 0.5 * x, abs=1e-6 * n)


def test_blend_equals_the_direct_fit_at_vertices(monkeypatch):
    """With vertices at every point the blended line is the direct one, errors included."""
    rng = np.random.default_rng(9)
    x = np.arange(40.0)
    y, weights = rng.random(40), rng.uniform(0.5, 2, 40)
    monkeypatch.setattr(series, "tree_vertices", lambda x, most: np.r_[x[0] - 1, x, x[-1] + 1])
    fitted, errors = series.blended_quadratic(x, y, weights, 0.5)
    exact, exact_errors = series.local_quadratic(x, y, weights, 0.5)
    assert fitted == pytest.approx(exact, abs=1e-9) and errors == pytest.approx(exact_errors, rel=1e-7)


def test_blended_loess_of_a_long_series_is_linear_in_memory():
    x = np.arange(20_000.0)
    y = np.sin(x / 3_000)
    fitted, errors = series.blended_quadratic(x, y, np.ones(len(x)), 0.3)
    for i in (0, 4_321, 10_000, 19_999):
        assert fitted[i] == pytest.approx(series._local_rows(x, np.ones(len(x)), x[i], 6_000)[0] @ y, abs=5e-3)
    assert (errors > 0).all()
