"""Detection rules as data: window features, a condition, a severity, a score and a context.

A rule is Column expressions only. :func:`detect` evaluates any set of rules that share the
(group, time) window in one exchange and one sort, whatever their number.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagwatch import schemas
from lagwatch.functions import texts
from lagwatch.functions.expr import alert_id, json_object, ladder, least_strict
from lagwatch.operators import timeline as tl
from lagwatch.operators.velocity import GROUP

CHUNK_SECONDS = tl.DAY


@dataclass(frozen=True)
class Rule:
    """One detection rule. ``lookback`` is the longest RANGE frame its features use, in seconds."""

    detection_type: str
    prefix: str
    where: Column
    severity: Column
    score: Column
    context: Column
    lookback: float = 0
    features: Mapping[str, Column] = field(default_factory=dict)

    def alert(self) -> Column:
        """The alert struct of a row, null where the rule does not fire."""
        values = {
            "alert_id": alert_id(self.prefix, F.col("consumer_group"), F.col("event_time")),
            "alert_time": F.col("event_time"),
            "detection_type": F.lit(self.detection_type),
            "severity": self.severity,
            "anomaly_score": self.score,
            "context": self.context,
        }
        fields = [
            values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in schemas.ALERTS
        ]
        return F.when(self.where, F.struct(*fields))


def detect(
    metrics: DataFrame,
    rules: Sequence[Rule],
    keys: Sequence[str] = GROUP,
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """Run rules over the metrics; rules without a frame need no shuffle at all."""
    frame = max(rule.lookback for rule in rules)
    rows = metrics
    if frame:
        rows = tl.spread_time(metrics, "event_time", chunk_seconds, before=frame)
        features = {name: col for rule in rules for name, col in rule.features.items()}
        rows = rows.withColumns(features).where(tl.OWN)
    if len(rules) == 1:
        return rows.where(rules[0].where).select(rules[0].alert().alias("_a")).select("_a.*")
    return rows.select(F.inline(F.array_compact(F.array(*[rule.alert() for rule in rules]))))


def lag_up_rule(
    min_lag: int = 1000, ratio: float = 1.5, warn: float = 2, crit: float = 3
) -> Rule:
    """Lag well above its 24-hour mean and still growing."""
    lag, mean = F.col("current_lag"), F.col("lag_24h_avg")
    relative = F.try_divide(lag.cast("double"), mean)
    return Rule(
        detection_type="arima_lag_up",
        prefix="arima_lag_up_",
        where=(lag > min_lag) & (F.col("lag_velocity") > 0) & (lag > mean * ratio),
        severity=F.when(lag > mean * crit, "critical")
        .when(lag > mean * warn, "warning")
        .otherwise("info"),
        score=least_strict(F.lit(1.0), relative / 5.0),
        context=json_object(
            lag_vs_avg_ratio=F.round(relative, 2),
            actual_lag=lag,
            lag_24h_avg=mean,
            lag_velocity=F.col("lag_velocity"),
            window_size_minutes=F.lit(10),
            model_type=F.lit("THRESHOLD"),
        ),
    )


def inactive_rule(
    lookback: float = 120, lo: float = 60, hi: float = 120, keys: Sequence[str] = GROUP
) -> Rule:
    """Not consuming for more than ``lo`` but less than ``hi`` seconds, with lag.

    A group that was never active inside the frame has no last active time and does not fire.
    """
    window = tl.seconds_range(tl.over(keys), lookback)
    active = F.when(F.col("read_speed") > 0, F.col("event_time"))
    idle = F.timestamp_diff("SECOND", F.col("_last_active"), F.col("event_time"))
    lag = F.col("current_lag")
    return Rule(
        detection_type="threshold_inactive",
        prefix="threshold_inactive_",
        lookback=lookback,
        features={
            "_last_active": F.last(active, ignorenulls=True).over(window),
            "_first_lag": F.first("current_lag").over(window),
        },
        where=(idle > lo) & (idle < hi) & (lag > 0),
        severity=F.lit("critical"),
        score=F.lit(1.0),
        context=json_object(
            inactive_duration_seconds=idle,
            last_active_time=F.col("_last_active").cast("string"),
            lag_growth=lag - F.coalesce(F.col("_first_lag"), lag),
            recommendation=F.lit(texts.INACTIVE_ADVICE),
        ),
    )


def rebalance_rule(
    lookback: float = 180,
    min_zeros: int = 3,
    bucket: int = 180,
    gate: str = "mod",
    keys: Sequence[str] = GROUP,
) -> Rule:
    """Repeated drops of the read speed to zero with a high variance."""
    window = tl.seconds_range(tl.over(keys), lookback)
    speed = F.col("read_speed")
    zeros, variance, mean = F.col("_zeros"), F.col("_variance"), F.col("_mean")
    condition = (zeros >= min_zeros) & ((variance > mean * 0.5) | (mean == 0))
    if gate == "mod":
        condition = condition & in_gate(F.col("event_time"), bucket)
    return Rule(
        detection_type="threshold_rebalance_storm",
        prefix="threshold_rebalance_",
        lookback=lookback,
        features={
            "_zeros": F.count_if(speed == 0).over(window),
            "_variance": F.var_samp(speed).over(window),
            "_mean": F.avg(speed).over(window),
        },
        where=condition,
        severity=ladder(zeros, [(5, "critical"), (3, "warning")], "info"),
        score=least_strict(zeros / 10.0, F.lit(1.0)),
        context=json_object(
            zero_speed_events=zeros,
            window_minutes=F.lit(3),
            speed_variance=variance,
            avg_speed=mean,
            possible_cause=F.lit(texts.REBALANCE_CAUSE),
            recommendation=F.lit(texts.REBALANCE_ADVICE),
        ),
    )


def lag_spike_rule(limit: int = 10_000) -> Rule:
    """Plain limit on the lag."""
    lag = F.col("current_lag")
    return Rule(
        detection_type="THRESHOLD_LAG_SPIKE",
        prefix="threshold_lag_spike_",
        where=lag > limit,
        severity=F.lit("HIGH"),
        score=F.lit(1.0),
        context=F.concat(F.lit(texts.LAG_SPIKE_TEXT), lag.cast("string")),
    )


# Rules by name, for callers that choose them by configuration.
REGISTRY: dict[str, Callable[..., Rule]] = {
    "threshold_lag_up": lag_up_rule,
    "threshold_lag_spike": lag_spike_rule,
    "threshold_inactive": inactive_rule,
    "rebalance_storm": rebalance_rule,
}


def configured(settings: Mapping[str, Mapping]) -> list[Rule]:
    """Rules from ``{name: {"enabled": bool, **parameters}}``."""
    return [
        REGISTRY[name](**{k: v for k, v in options.items() if k != "enabled"})
        for name, options in settings.items()
        if options.get("enabled", True)
    ]


def in_gate(time: Column, bucket: int, open_seconds: int = 10) -> Column:
    """True in the first seconds of every bucket."""
    return F.pmod(F.unix_seconds(time), F.lit(bucket)) < open_seconds


def threshold_lag_up(metrics: DataFrame, **parameters) -> DataFrame:
    return detect(metrics, [lag_up_rule(**parameters)])


def threshold_lag_spike(metrics: DataFrame, limit: int = 10_000) -> DataFrame:
    return detect(metrics, [lag_spike_rule(limit)])


def threshold_inactive(metrics: DataFrame, **parameters) -> DataFrame:
    return detect(metrics, [inactive_rule(**parameters)])


def rebalance_storm(metrics: DataFrame, bucket: int = 180, gate: str = "mod", **parameters) -> DataFrame:
    """``gate='first_in_bucket'`` emits exactly once per bucket whatever the poll cadence."""
    from lagwatch.operators.alerts import first_in_bucket

    found = detect(metrics, [rebalance_rule(bucket=bucket, gate=gate, **parameters)])
    return first_in_bucket(found, bucket) if gate == "first_in_bucket" else found


#: Of measures that are averaged without error: fourteen decimals, as many as a double holds; sums of ten million.
_EXACT, _EXACT_SUM = "decimal(26,14)", "decimal(33,14)"


def moving_avg_spike(
    metrics: DataFrame,
    value: str = "read_speed",
    rows: int = 100,
    factor: float = 2,
    keys: Sequence[str] = GROUP,
    detection_type: str | None = None,
    block: int = 4096,
) -> DataFrame:
    """Any measure above ``factor`` times its mean of the last ``rows`` rows and itself.

    Unless named, the detection type is that of the measure: a spike of ``cpu`` is a CPU_SPIKE.
    A row at exactly ``factor`` times the mean is no spike, so sums and the comparison are decimals; frames
    that hold a value too large for them (or not a number) are compared as doubles.
    """
    numbered = tl.number_by_time(metrics.select(*keys, "event_time", value), keys, "event_time")
    spread = tl.spread_rows(numbered, tl.ROW, block, rows)
    window = tl.Window.partitionBy(*keys, tl.CHUNK).orderBy(tl.ROW).rowsBetween(-rows, 0)
    spread = spread.withColumn("_exact", F.col(value).try_cast(_EXACT))
    counted = {"_n": F.count(value).over(window), "_exact_n": F.count("_exact").over(window)}
    averaged = spread.withColumns(
        {"_sum": tl.trailing_rows("_exact", window, rows), "_double": F.avg(value).over(window), **counted}
    )
    exact = F.col("_n") == F.col("_exact_n")
    mean = F.when(exact, F.try_divide(F.col("_sum").cast("double"), F.col("_n"))).otherwise(F.col("_double"))
    above = F.col("_exact") * F.col("_n").cast("decimal(7,0)") > F.col("_sum").cast(_EXACT_SUM) * F.lit(Decimal(str(factor)))
    spike = F.when(exact, above).otherwise(F.col(value) > F.col("_double") * factor)
    averaged = averaged.withColumn("moving_avg", mean).where(spike)
    return tl.own_rows(averaged, tl.ROW).select(
        *keys,
        F.lit(detection_type or f"{value.upper()}_SPIKE").alias("detection_type"),
        F.lit("critical").alias("severity"),
        F.col(value).cast("string").alias("metric_value"),
        F.col(value).alias("value"),
        "moving_avg",
        "event_time",
    )


# A configured rule list is a handful of lines; beyond this it is joined as an ordinary table.
MAX_BROADCAST_RULES = 1000


def rule_table(metrics: DataFrame, rules: Sequence[Mapping]) -> DataFrame:
    """Limits from configuration: ``{detector, measure, enabled, critical, high}`` per rule.

    Metrics are unpivoted to the measures the rules name and equi-joined with the rules.
    """
    spark = metrics.sparkSession
    active = [r for r in rules if r["enabled"]]
    measures = sorted({r["measure"] for r in active})
    table = spark.createDataFrame(
        [(r["detector"], r["measure"], float(r["critical"]), float(r["high"])) for r in active],
        "detector string, measure string, critical double, high double",
    )
    if len(active) <= MAX_BROADCAST_RULES:
        table = F.broadcast(table)
    ids = ["event_time", "cluster_id", "consumer_group", "topic"]
    long = metrics.select(
        *ids, *[F.col(m).cast("double").alias(m) for m in measures]
    ).unpivot(ids, measures, "measure", "value")
    severity = F.when(F.col("value") > F.col("critical"), "critical").when(
        F.col("value") > F.col("high"), "high"
    )
    return (
        long.join(table, "measure")
        .withColumn("severity", severity)
        .where(F.col("severity").isNotNull())
        .select(*ids, "detector", "measure", "value", "severity")
    )
