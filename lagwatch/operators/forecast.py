"""Rolling forecast detector and the three forecast rules."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lagwatch import schemas
from lagwatch.functions import arima, texts
from lagwatch.functions.expr import deviation_percent, json_object, ladder
from lagwatch.operators import timeline as tl
from lagwatch.operators.velocity import GROUP
from lagwatch.operators.rules import Rule, detect

RESULT = T.StructType(
    [
        T.StructField("is_anomaly", T.BooleanType()),
        T.StructField("anomaly_score", T.DoubleType()),
        T.StructField("prediction", T.DoubleType()),
    ]
)
BLOCK_ROWS = 4096
_CELLS = 1 << 20


def forecast(
    df: DataFrame,
    value: str,
    p: int = 3,
    d: int = 1,
    q: int = 2,
    seasonality: int = 12,
    threshold: float = 0.5,
    training_window: int = 100,
    algorithm: str = "ARIMA",
    keys: Sequence[str] = GROUP,
    chunk_rows: int = BLOCK_ROWS,
    per_unit: int = 10_000,
) -> DataFrame:
    """Add ``anomaly_data`` (is_anomaly, anomaly_score, prediction) per row.

    The model sees the ``training_window`` rows before the row. Rows are numbered per key and cut
    into blocks of equal length that overlap by one window, so a key of any size is spread evenly.

    Algorithms: ``ARIMA`` (numpy); ``AR``, the same least squares on the orders ``p`` and ``d`` alone, in
    JVM windows over values in ``per_unit``-ths; ``ZSCORE``, mean and deviation (numpy).
    """
    numbered = tl.number_by_time(df, keys, "event_time")
    spread = tl.spread_rows(numbered, tl.ROW, chunk_rows, training_window)
    if algorithm == "ZSCORE":
        return _zscore(spread, value, threshold, training_window, keys)
    if algorithm == "AR":
        return _autoregressive(spread, value, p, d, threshold, training_window, keys, per_unit)
    if algorithm != "ARIMA":
        raise ValueError(f"unknown algorithm {algorithm!r}")

    names = df.columns
    flat = T.StructType([*df.schema.fields, *RESULT.fields])

    def detect_block(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(tl.ROW, kind="stable")
        scores, predictions = arima.detect_series(
            pdf[value].to_numpy(dtype=float), p, d, q, seasonality, training_window
        )
        # comparisons with the warm-up's NaN are false
        found = pdf[names].assign(
            is_anomaly=scores > threshold, anomaly_score=scores, prediction=predictions
        )
        return found[pdf[tl.OWN].to_numpy()]

    def known(name: str) -> Column:
        return F.when(~F.isnan(name), F.col(name)).alias(name)

    detected = spread.groupBy(*keys, tl.CHUNK).applyInPandas(detect_block, flat)
    result = F.struct("is_anomaly", known("anomaly_score"), known("prediction"))
    return detected.select(*names, result.alias("anomaly_data"))


def trailing_moments(values: np.ndarray, known: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Count, mean and sum of squared deviations of the known values among the ``rows`` before each value.

    Only from the value at ``rows`` on, the first that has so many before it. Deviations are taken from the first known
    value of each window, so equal values give exactly their value and zero. Windows are laid out a million cells at a time.
    """
    counts, means, squares = (np.zeros(max(len(values) - rows, 0)) for _ in range(3))
    step = max(1, _CELLS // rows)
    for low in range(0, len(counts), step):
        high = min(low + step, len(counts))
        seen = sliding_window_view(known[low : high + rows - 1], rows)
        x = sliding_window_view(values[low : high + rows - 1], rows)
        n = seen.sum(axis=1)
        first = x[np.arange(high - low), seen.argmax(axis=1)]
        away = np.where(seen, x - first[:, None], 0.0)
        mean = away.sum(axis=1) / np.maximum(n, 1)
        off = np.where(seen, away - mean[:, None], 0.0)
        counts[low:high], means[low:high], squares[low:high] = n, first + mean, (off * off).sum(axis=1)
    return counts, means, squares


def _zscore(
    spread: DataFrame, value: str, threshold: float, rows: int, keys: Sequence[str]
) -> DataFrame:
    """Mean and sample deviation of the preceding rows as the forecast.

    A sliding frame of Spark adds up all its rows anew for each row; here a block's windows are summed at once in
    numpy, on Arrow tables whose other columns pass through unconverted.
    """
    names = [c for c in spread.columns if c not in (tl.CHUNK, tl.OWN)]
    doubles = [T.StructField(name, T.DoubleType()) for name in ("_x", "_mean", "_sigma")]
    schema = T.StructType([*(spread.schema[c] for c in names), *doubles])

    def measure(block: pa.Table) -> pa.Table:
        block = block.sort_by(tl.ROW)
        x = block["_x"].combine_chunks()
        known = x.is_valid().to_numpy(zero_copy_only=False)
        with np.errstate(invalid="ignore"):
            n, mean, square = trailing_moments(x.fill_null(0.0).to_numpy(zero_copy_only=False), known, rows)
            sigma = np.sqrt(square / np.maximum(n - 1, 1))
        early = np.ones(min(rows, len(known)), bool)
        for name, found, least in (("_mean", mean, 1), ("_sigma", sigma, 2)):
            missing = np.concatenate([early, n < least])
            block = block.append_column(name, pa.array(np.concatenate([np.zeros(len(early)), found]), mask=missing))
        return block.filter(block[tl.OWN]).select(schema.names)

    blocks = spread.withColumn("_x", F.col(value).cast("double")).groupBy(*keys, tl.CHUNK)
    mean, sigma = F.col("_mean"), F.col("_sigma")
    full = F.col(tl.ROW) > rows
    miss = F.abs(F.col("_x") - mean)
    known = full & F.col("_x").isNotNull() & sigma.isNotNull()  # least() would take a missing score for 1
    score = F.when(known, F.when(sigma == 0, F.when(miss == 0, 0.0).otherwise(1.0)).otherwise(
        F.least(F.try_divide(miss, sigma) / arima.SIGMAS_AT_FULL_SCORE, F.lit(1.0))
    ))
    result = F.struct(
        F.coalesce(F.col("_score") > threshold, F.lit(False)).alias("is_anomaly"),
        F.col("_score").alias("anomaly_score"),
        F.when(full, mean).alias("prediction"),
    )
    measured = blocks.applyInArrow(measure, schema).withColumn("_score", score)
    return measured.withColumn("anomaly_data", result).drop(tl.ROW, "_x", "_mean", "_sigma", "_score")


def _autoregressive(
    spread: DataFrame, value: str, p: int, d: int, threshold: float, rows: int, keys: Sequence[str], per_unit: int
) -> DataFrame:
    """Least squares of each row on the ``p`` before it, over the rows of the window, by sliding normal equations.

    Values become whole numbers of 1/``per_unit``, so that the sums of cross products of a frame are exact
    differences of two prefix sums, whatever the block. The equations are solved by elimination in doubles; a
    lag that depends on the earlier ones gets coefficient 0. Null values give no forecast for the rows that see them.
    """
    if d not in (0, 1) or rows - d - p <= p + 1:
        raise ValueError("AR takes d = 0 or 1 and a window of more than 2 p + d + 1 rows")
    order = Window.partitionBy(*keys, tl.CHUNK).orderBy(tl.ROW)
    targets = rows - d - p
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    gone = order.rowsBetween(Window.unboundedPreceding, -targets - 1)

    def framed(x: Column) -> Column:
        return (F.sum(x).over(upto) - F.coalesce(F.sum(x).over(gone), F.lit(0))).cast("double")

    whole = F.floor(F.col(value).cast("double") * per_unit + 0.5).cast("decimal(19,0)")
    before = F.lag("_x").over(order)
    lagged = [f"_y{i}" for i in range(p + 1)]
    series = spread.withColumn("_x", whole).withColumn("_y0", F.col("_x") - before if d else F.col("_x"))
    series = series.withColumns({name: F.lag("_y0", k).over(order) for k, name in enumerate(lagged) if k})
    pairs = [(i, j) for i in range(p + 1) for j in range(i, p + 1)]
    complete = F.when(F.count("_x").over(order.rowsBetween(-rows, -1)) == rows, F.lit(True))
    summed = series.withColumns(
        {
            "_seen": complete,
            "_base": before.cast("double") if d else F.lit(0.0),
            **{f"_s{i}": framed(F.col(name)) for i, name in enumerate(lagged)},
            **{f"_a{i}{j}": framed(F.col(lagged[i]) * F.col(lagged[j])) for i, j in pairs},
        }
    )
    solved = summed.withColumns(
        {f"_a{i}{j}": F.col(f"_a{i}{j}") * targets - F.col(f"_s{i}") * F.col(f"_s{j}") for i, j in pairs}
    )
    solved = solved.withColumns({f"_c{i}": F.col(f"_a0{i}") for i in range(1, p + 1)})
    solved = solved.withColumns({f"_d{i}": F.col(f"_a{i}{i}") * 1e-9 for i in range(1, p + 1)})
    for k in range(1, p):
        pivot, live = F.col(f"_a{k}{k}"), F.col(f"_a{k}{k}") > F.col(f"_d{k}")
        factor = {i: F.when(live, F.col(f"_a{k}{i}") / pivot).otherwise(0.0) for i in range(k + 1, p + 1)}
        solved = solved.withColumns({f"_f{i}": f for i, f in factor.items()})
        reduced = {f"_c{i}": F.col(f"_c{i}") - F.col(f"_f{i}") * F.col(f"_c{k}") for i in factor}
        for i in factor:
            for j in range(i, p + 1):
                reduced[f"_a{i}{j}"] = F.col(f"_a{i}{j}") - F.col(f"_f{i}") * F.col(f"_a{k}{j}")
        solved = solved.withColumns(reduced)
    for k in range(p, 0, -1):
        rest = F.col(f"_c{k}")
        for j in range(k + 1, p + 1):
            rest = rest - F.col(f"_a{k}{j}") * F.col(f"_b{j}")
        live = F.col(f"_a{k}{k}") > F.col(f"_d{k}")
        solved = solved.withColumn(f"_b{k}", F.when(live, rest / F.col(f"_a{k}{k}")).otherwise(0.0))

    error, level, ahead = F.col("_a00"), F.col("_s0"), F.lit(0.0)
    for k in range(1, p + 1):
        error = error - F.col(f"_b{k}") * F.col(f"_a0{k}")
        level = level - F.col(f"_b{k}") * F.col(f"_s{k}")
        ahead = ahead + F.col(f"_b{k}") * F.col(lagged[k]).cast("double")
    # a generator ends the chain of projections: filters on the forecast would be rewritten through all of it
    fit = F.struct(error.alias("_error"), (F.col("_base") + level / targets + ahead).alias("_ahead"))
    given = [c for c in spread.columns if c not in (tl.CHUNK, tl.OWN, tl.ROW)]
    solved = solved.where(tl.OWN).select(*given, "_x", "_seen", "_a00", F.inline(F.array(fit)))
    miss = F.abs(F.col("_x").cast("double") - F.col("_ahead"))
    sigma = F.sqrt(F.col("_error") / targets / (targets - p - 1))
    score = F.when(
        F.col("_error") <= F.col("_a00") * 1e-12,
        F.when(miss <= (F.abs("_ahead") + 1) * 1e-6, 0.0).otherwise(1.0),
    ).otherwise(F.least(miss / sigma / arima.SIGMAS_AT_FULL_SCORE, F.lit(1.0)))
    result = F.struct(
        F.coalesce(F.col("_score") > threshold, F.lit(False)).alias("is_anomaly"),
        F.col("_score").alias("anomaly_score"),
        F.when(F.col("_seen"), F.col("_ahead") / per_unit).alias("prediction"),
    )
    scored = solved.withColumn("_score", F.when(F.col("_seen") & F.col("_x").isNotNull(), score))
    return scored.select(*given, result.alias("anomaly_data"))


def _rule(detection_type: str, where: Column, context: Column) -> Rule:
    score = F.col("anomaly_data.anomaly_score")
    return Rule(
        detection_type=detection_type,
        prefix=f"{detection_type}_",
        where=F.col("anomaly_data.is_anomaly") & where,
        severity=ladder(score, [(0.8, "critical"), (0.5, "warning")], "info"),
        score=score,
        context=context,
    )


def _read(metrics: DataFrame, *more: str, keys: Sequence[str] = GROUP, **_) -> DataFrame:
    """The columns of an alert, of its keys and those a rule names besides: others stay out of the shuffles."""
    names = {"event_time", *keys, *more, *schemas.ALERTS.fieldNames()}
    return metrics.select(*[c for c in metrics.columns if c in names])


def forecast_lag_up(metrics: DataFrame, algorithm: str = "ARIMA", **parameters) -> DataFrame:
    """Lag above its forecast, growing, and above 1000. Rows without lag are not trained on."""
    lag, predicted = F.col("current_lag"), F.col("anomaly_data.prediction")
    scored = forecast(
        _read(metrics.where(lag > 0), "lag_velocity", **parameters), "current_lag", algorithm=algorithm, **parameters
    )
    context = json_object(
        predicted_lag=predicted,
        actual_lag=lag,
        deviation_percent=deviation_percent(lag, predicted),
        lag_velocity=F.col("lag_velocity"),
        window_size_minutes=F.lit(10),
        model_type=F.lit(algorithm),
    )
    where = (F.col("lag_velocity") > 0) & (lag > 1000)
    return detect(scored, [_rule("arima_lag_up", where, context)])


def forecast_speed_down(metrics: DataFrame, algorithm: str = "ARIMA", **parameters) -> DataFrame:
    """Read speed more than 20 percent below its forecast. Idle rows are not trained on."""
    speed, predicted = F.col("read_speed"), F.col("anomaly_data.prediction")
    active = _read(metrics.where(speed > 0), "speed_ratio", "is_falling_behind", **parameters)
    scored = forecast(active, "read_speed", algorithm=algorithm, **parameters)
    context = json_object(
        predicted_speed=predicted,
        actual_speed=speed,
        deviation_percent=deviation_percent(speed, predicted),
        speed_ratio=F.col("speed_ratio"),
        is_falling_behind=F.col("is_falling_behind"),
        model_type=F.lit(algorithm),
    )
    where = (speed < predicted) & (F.try_divide(predicted - speed, predicted) > 0.2)
    return detect(scored, [_rule("arima_speed_down", where, context)])


def forecast_hot_partition(metrics: DataFrame, algorithm: str = "ARIMA", **parameters) -> DataFrame:
    """Partition skew above its forecast and above 2."""
    skew, predicted = F.col("partition_skew_score"), F.col("anomaly_data.prediction")
    settings = {
        "p": 2, "d": 1, "q": 1, "seasonality": 6, "threshold": 0.6, "training_window": 80,
        **parameters,
    }
    scored = forecast(
        _read(metrics.where((F.col("partition_count") > 1) & (skew > 0)), "partition_count", **parameters),
        "partition_skew_score",
        algorithm=algorithm,
        **settings,
    )
    context = json_object(
        predicted_skew=predicted,
        actual_skew=skew,
        deviation_percent=deviation_percent(skew, predicted),
        partition_count=F.col("partition_count"),
        recommendation=F.lit(texts.HOT_PARTITION_ADVICE),
        model_type=F.lit(algorithm),
    )
    where = (skew > predicted) & (skew > 2.0)
    return detect(scored, [_rule("arima_hot_partition", where, context)])


def forecast_alerts(metrics: DataFrame, **parameters) -> list[DataFrame]:
    """The three forecast rules over one table."""
    return [rule(metrics, **parameters) for rule in (forecast_lag_up, forecast_speed_down, forecast_hot_partition)]
