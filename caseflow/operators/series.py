"""Series operators (ML8-ML11): STL, LOESS, histogram, kernel density.

STL and LOESS run as grouped-map jobs over *monthly counts*: one group is one
series, whose length is its number of months.  Spark spreads the series.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.session import settle

PERIOD = 12


# ---- local regression on an evenly spaced series -------------------------------------------


def _tricube(distance: np.ndarray, width: np.ndarray) -> np.ndarray:
    ratio = np.clip(distance / width, 0.0, 1.0)
    return (1 - ratio ** 3) ** 3


def _even_loess(y: np.ndarray, window: int, degree: int, at: np.ndarray) -> np.ndarray:
    """Local fit of degree 0 or 1 at positions ``at`` (0-based, may lie outside)."""
    n = len(y)
    x = np.arange(n, dtype=float)
    distance = np.abs(at[:, None] - x[None, :])
    reach = np.sort(distance, axis=1)[:, min(window, n) - 1]
    if window > n:  # a window longer than the series widens the bandwidth
        reach = reach + (window - n) // 2
    reach = np.maximum(reach, 1e-12)
    w = _tricube(distance, reach[:, None])
    w[distance > 0.999 * reach[:, None]] = 0.0
    w[distance <= 0.001 * reach[:, None]] = 1.0
    w /= w.sum(axis=1, keepdims=True)
    if degree:
        centre = (w * x).sum(axis=1, keepdims=True)
        spread = (w * (x - centre) ** 2).sum(axis=1, keepdims=True)
        usable = np.sqrt(spread) > 0.001 * max(n - 1, 1)
        tilt = np.where(usable, (at[:, None] - centre) / np.where(usable, spread, 1.0), 0.0)
        w = w * (1 + tilt * (x - centre))
    return w @ y


def _stepped_loess(y: np.ndarray, window: int, degree: int, jump: int) -> np.ndarray:
    """Fits at every ``jump``-th point and at the end; straight lines in between."""
    n = len(y)
    at = np.unique(np.append(np.arange(0, n, jump), n - 1)).astype(float)
    return np.interp(np.arange(n), at, _even_loess(y, window, degree, at))


def _moving_average(y: np.ndarray, length: int) -> np.ndarray:
    total = np.cumsum(np.insert(y, 0, 0.0))
    return (total[length:] - total[:-length]) / length


def _next_odd(x: float) -> int:
    n = math.ceil(x)
    return n if n % 2 else n + 1


def stl_periodic(y: np.ndarray, period: int = PERIOD, inner: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Seasonal and trend parts with a seasonal pattern that never changes.

    Cleveland et al. (1990) with degree 0 and a very wide window for the cycle
    subseries, degree 1 elsewhere, two inner rounds and no robustness rounds;
    the seasonal part is then replaced by its mean per calendar position.
    """
    n = len(y)
    if n < 2 * period:
        raise ValueError("a seasonal decomposition needs at least two full periods")
    s_window = 10 * n + 1
    t_window = _next_odd(1.5 * period / (1 - 1.5 / s_window))
    l_window = _next_odd(period)
    trend = np.zeros(n)
    seasonal = np.zeros(n)
    for _ in range(inner):
        detrended = y - trend
        extended = np.empty(n + 2 * period)
        for phase in range(period):
            sub = detrended[phase::period]
            at = np.arange(-1, len(sub) + 1, dtype=float)
            extended[phase::period][: len(at)] = _even_loess(sub, s_window, 0, at)
        low = _moving_average(_moving_average(_moving_average(extended, period), period), 3)
        low = _stepped_loess(low, l_window, 1, math.ceil(l_window / 10))
        seasonal = extended[period: period + n] - low
        trend = _stepped_loess(y - seasonal, t_window, 1, math.ceil(t_window / 10))
    phases = np.arange(n) % period
    means = np.array([seasonal[phases == p].mean() for p in range(period)])
    return means[phases], trend


def decompose(series: DataFrame, key: str, month: str = "mes", value: str = "n") -> DataFrame:
    """ML8/Q18: observed, trend, seasonal and remainder of each gap-free monthly series, long.

    A series shorter than two years has no decomposition: its observed values come with NULL parts, and ``motivo``
    says why; it is NULL for the others.
    """
    schema = f"`{key}` {series.schema[key].dataType.simpleString()}, data date, componente string, valor double, motivo string"

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(month)
        y = pdf[value].to_numpy(dtype=float)
        short = len(y) < 2 * PERIOD
        seasonal, trend = (np.full(len(y), np.nan),) * 2 if short else stl_periodic(y)
        reason = "fewer than two full periods" if short else None
        parts = {"observed": y, "trend": trend, "seasonal": seasonal, "remainder": y - seasonal - trend}
        return pd.concat([
            pd.DataFrame({key: pdf[key].to_numpy(), "data": pdf[month].to_numpy(),
                          "componente": name,
                          "valor": [None if np.isnan(v) else v for v in part], "motivo": reason})
            for name, part in parts.items()])

    return series.select(key, month, value).groupBy(key).applyInPandas(one, schema)


def _span_size(n: int, span: float) -> int:
    return max(min(int(math.floor(n * span + 1e-5)), n), 3)


def _local_rows(x: np.ndarray, weights: np.ndarray, at: float, q: int) -> tuple[np.ndarray, np.ndarray]:
    """How the values add up to the level and the slope at one point of the local quadratic through its ``q`` neighbours."""
    distance = np.abs(x - at)
    scale = max(float(np.partition(distance, q - 1)[q - 1]), 1e-12)
    root = np.sqrt(_tricube(distance, np.full(len(x), scale)) * weights)[:, None]
    rows = np.linalg.pinv(np.vander((x - at) / scale, 3, increasing=True) * root) * root.T
    return rows[0], rows[1] / scale


def _with_errors(y: np.ndarray, weights: np.ndarray, fitted: np.ndarray, trace: float, squares: np.ndarray, spread: np.ndarray):
    """Standard errors of a linear smoother from its trace and, per row, the sums of squares with and without weights."""
    freedom = len(y) - 2 * trace + float(squares.sum())
    scale2 = float(np.sum(weights * (y - fitted) ** 2) / freedom) if freedom > 1e-9 else float("nan")
    return fitted, np.sqrt(np.maximum(scale2 * spread, 0.0))


def local_quadratic(
    x: np.ndarray, y: np.ndarray, weights: np.ndarray, span: float
) -> tuple[np.ndarray, np.ndarray]:
    """LOESS of degree 2 at every x with standard errors, by direct computation, one row of the smoother at a time."""
    n, q = len(x), _span_size(len(x), span)
    fitted, squares, spread, trace = np.empty(n), np.empty(n), np.empty(n), 0.0
    inverse = 1 / np.where(weights > 0, weights, np.inf)
    for i in range(n):
        row, _ = _local_rows(x, weights, x[i], q)
        fitted[i], squares[i], spread[i] = row @ y, row @ row, row ** 2 @ inverse
        trace += row[i]
    return _with_errors(y, weights, fitted, trace, squares, spread)


def tree_vertices(x: np.ndarray, most: int) -> np.ndarray:
    """Cell borders of a k-d tree over sorted positions: cells are halved at their median until they hold ``most`` points."""
    margin = 0.1 * max(x[-1] - x[0], 1e-10 * max(abs(x[0]), abs(x[-1])) + 1e-30)
    borders, todo = [x[0] - margin, x[-1] + margin], [(0, len(x))]
    while todo:
        start, end = todo.pop()
        middle = (start + end) // 2
        if end - start <= most or x[middle - 1] == x[middle]:
            continue
        borders.append((x[middle - 1] + x[middle]) / 2)
        todo += [(start, middle), (middle, end)]
    return np.unique(borders)


def blended_quadratic(
    x: np.ndarray, y: np.ndarray, weights: np.ndarray, span: float, cell: float = 0.2
) -> tuple[np.ndarray, np.ndarray]:
    """LOESS of degree 2 with standard errors, fitted at the vertices of a k-d tree and blended in between.

    Cells hold ``span * cell`` of the points at most, so there are a few dozen vertices whatever the length of the series.
    Level and slope at both ends of a cell make the cubic inside it. The smoother is the product of that blend (four
    numbers per point) and the vertices' rows, so its trace and row sums of squares take memory in proportion to the points.
    """
    order = np.argsort(x, kind="stable")
    x, y, weights = x[order], y[order], weights[order]
    n, q = len(x), _span_size(len(x), span)
    borders = tree_vertices(x, max(int(n * span * cell), 1))
    rows = np.array([_local_rows(x, weights, v, q) for v in borders])  # vertices, (level, slope), points
    left = np.clip(np.searchsorted(borders, x, side="right") - 1, 0, len(borders) - 2)
    width = borders[left + 1] - borders[left]
    t = (x - borders[left]) / width
    blend = np.column_stack([(1 - t) ** 2 * (1 + 2 * t), t * (1 - t) ** 2 * width, t ** 2 * (3 - 2 * t), -t ** 2 * (1 - t) * width])
    ends = np.stack([rows[left, 0, np.arange(n)], rows[left, 1, np.arange(n)],
                     rows[left + 1, 0, np.arange(n)], rows[left + 1, 1, np.arange(n)]], axis=1)
    trace = float((blend * ends).sum())
    level, slope = rows[:, 0] @ y, rows[:, 1] @ y
    fitted = (blend * np.column_stack([level[left], slope[left], level[left + 1], slope[left + 1]])).sum(axis=1)
    inverse = 1 / np.where(weights > 0, weights, np.inf)

    def row_sums(by: np.ndarray) -> np.ndarray:
        """Per point the sum of squares of its row: the blend around the products of its cell's four vertex rows."""
        own = [np.concatenate([rows[k], rows[k + 1]]) for k in range(len(borders) - 1)]
        products = np.array([(r * by) @ r.T for r in own])
        return np.einsum("ia,iab,ib->i", blend, products[left], blend)

    fitted, errors = _with_errors(y, weights, fitted, trace, row_sums(np.ones(n)), row_sums(inverse))
    back = np.argsort(order, kind="stable")
    return fitted[back], errors[back]


def smooth(
    series: DataFrame, key: str, month: str, value: str, span: float = 0.75, weight: str | None = None,
    surface: str = "interpolate",
) -> DataFrame:
    """ML9: LOESS line and standard error of each monthly series.

    ``surface``: "interpolate" fits at the vertices of a k-d tree and blends in between, "direct" fits at every point.
    """
    schema = (f"`{key}` {series.schema[key].dataType.simpleString()}, data date, "
              "observado double, ajuste double, erro_padrao double")
    columns = [key, month, value] + ([weight] if weight else [])
    fit = {"interpolate": blended_quadratic, "direct": local_quadratic}[surface]

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(month)
        days = pd.to_datetime(pdf[month])
        x = (days - days.iloc[0]).dt.days.to_numpy(dtype=float)
        y = pdf[value].to_numpy(dtype=float)
        w = pdf[weight].to_numpy(dtype=float) if weight else np.ones(len(y))
        fitted, errors = fit(x, y, w, span)
        return pd.DataFrame({key: pdf[key].to_numpy(), "data": pdf[month].to_numpy(), "observado": y,
                             "ajuste": fitted, "erro_padrao": errors})

    return series.select(*columns).groupBy(key).applyInPandas(one, schema)


# ---- distributions of event times ------------------------------------------------------------


def _range(frame: DataFrame, value: str) -> tuple[float, float] | None:
    row = frame.agg(F.min(value).alias("a"), F.max(value).alias("b")).first()
    return None if row.a is None else (float(row.a), float(row.b))


def histogram(frame: DataFrame, value: str, bins: int = 100) -> DataFrame:
    """ML10: equal bins, the first centred on the minimum and the last on the maximum.

    Bins are closed on the right; empty bins are listed with 0.
    """
    schema = "faixa int, centro double, n bigint"
    spark = frame.sparkSession
    ends = _range(frame, value)
    if ends is None:
        return spark.createDataFrame([], schema)
    low, high = ends
    width = (high - low) / (bins - 1) if high > low else 1.0
    place = F.least(F.greatest(F.ceil((F.col(value) - F.lit(low)) / F.lit(width) - 0.5), F.lit(0)),
                    F.lit(bins - 1)).cast("int")
    counts = frame.filter(F.col(value).isNotNull()).groupBy(place.alias("faixa")).agg(
        F.count("*").alias("n"))
    zeros = spark.range(bins).select(F.col("id").cast("int").alias("faixa"), F.lit(0).cast("bigint").alias("n"))
    return (
        counts.unionByName(zeros).groupBy("faixa").agg(F.sum("n").alias("n"))
        .select("faixa", (F.lit(low) + F.col("faixa") * F.lit(width)).alias("centro"), "n")
    )


def rule_of_thumb_bandwidth(n: float, sd: float, q1: float, q3: float) -> float:
    """0.9 min(sd, IQR / 1.34) n^(-1/5), falling back to sd when the IQR is 0."""
    spread = min(sd, (q3 - q1) / 1.34) or sd or 1.0
    return 0.9 * spread * n ** -0.2


#: Grid cells per bandwidth at least, and how many bandwidths a kernel reaches (its value there is under 1e-10).
_CELLS_PER_BANDWIDTH, _REACH = 4, 7


def kernel_density(frame: DataFrame, value: str, bandwidth: float, points: int = 512) -> DataFrame:
    """ML11: Gaussian density on ``points`` values from minimum to maximum; no rows without values.

    Values are first split linearly between neighbouring cells of a grid that reaches four bandwidths past the data
    and whose cells are a quarter of the bandwidth at most, however narrow that is. Only cells that hold values exist;
    each of them meets the output points within the kernel's reach, and the density is read off by interpolation.
    """
    spark = frame.sparkSession
    ends = _range(frame, value)
    if ends is None:
        return spark.createDataFrame([], "x double, densidade double")
    low, high = ends
    start, stop = low - 4 * bandwidth, high + 4 * bandwidth
    cell = min((stop - start) / (points - 1), bandwidth / _CELLS_PER_BANDWIDTH)
    position = (F.col(value) - F.lit(start)) / F.lit(cell)
    left = F.floor(position)
    share = position - left
    # equal cells first, so that the shuffle carries grid rows only
    halves = settle(frame.filter(F.col(value).isNotNull()).groupBy(left.alias("i")).agg(
        F.sum(1 - share).alias("a"), F.sum(share).alias("b"), F.count("*").alias("n")))
    mass = halves.select(F.explode(F.array(
        F.struct(F.col("i").alias("i"), F.col("a").alias("m")),
        F.struct((F.col("i") + 1).alias("i"), F.col("b").alias("m")))).alias("p")
    ).groupBy("p.i").agg(F.sum("p.m").alias("m"))
    total = halves.agg(F.sum("n")).first()[0]
    step = (high - low) / (points - 1)
    out = spark.range(points).select((F.lit(low) + F.col("id") * F.lit(step)).alias("x")).withColumn(
        "_p", (F.col("x") - F.lit(start)) / F.lit(cell)).withColumn("j", F.floor("_p"))
    reach = math.ceil(_REACH * bandwidth / cell)
    # the two cells beside each point, in the blocks of cells that can reach them: six rows per point
    wanted = out.select(F.explode(F.array("j", F.col("j") + 1)).alias("j")).distinct().select(
        "j", F.explode(F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda k: F.floor(F.col("j") / reach) + k)).alias("block"))
    near = mass.withColumn("block", F.floor(F.col("i") / reach)).join(F.broadcast(wanted), "block").filter(
        F.abs(F.col("j") - F.col("i")) <= reach)
    u = (F.col("j") - F.col("i")) * F.lit(cell / bandwidth)
    smoothed = near.groupBy("j").agg(
        (F.sum(F.col("m") * F.exp(-u * u / 2)) / F.lit(total * bandwidth * math.sqrt(2 * math.pi))).alias("d"))
    at, after = F.broadcast(smoothed), F.broadcast(smoothed.select((F.col("j") - 1).alias("j"), F.col("d").alias("d_next")))
    here = F.coalesce("d", F.lit(0.0))  # no value within reach
    return out.join(at, "j", "left").join(after, "j", "left").select(
        "x", (here + (F.coalesce("d_next", F.lit(0.0)) - here) * (F.col("_p") - F.col("j"))).alias("densidade"))
