"""All detectors by name, for callers that choose them by configuration."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from lagwatch.operators import correlate, forecast, rules

#: Each takes metric rows and its own parameters.
DETECTORS: dict[str, Callable[..., DataFrame]] = {
    "threshold_lag_up": rules.threshold_lag_up,
    "threshold_lag_spike": rules.threshold_lag_spike,
    "threshold_inactive": rules.threshold_inactive,
    "rebalance_storm": rules.rebalance_storm,
    "correlation": correlate.correlation,
    "moving_avg_spike": rules.moving_avg_spike,
    "rule_table": rules.rule_table,
    "forecast_lag_up": forecast.forecast_lag_up,
    "forecast_speed_down": forecast.forecast_speed_down,
    "forecast_hot_partition": forecast.forecast_hot_partition,
}


def run_configured(metrics: DataFrame, settings: Mapping[str, Mapping]) -> dict[str, DataFrame]:
    """Results by name of the detectors in ``{name: {"enabled": bool, **parameters}}``.

    Rules on a group's window that are enabled together share one pass over the metrics.
    """
    enabled = {
        name: {k: v for k, v in options.items() if k != "enabled"}
        for name, options in settings.items()
        if options.get("enabled", True)
    }
    unknown = enabled.keys() - DETECTORS.keys()
    if unknown:
        raise ValueError(f"unknown detectors: {', '.join(sorted(unknown))}")
    shared = [n for n, p in enabled.items() if n in rules.REGISTRY and p.get("gate", "mod") == "mod"]
    out = {n: DETECTORS[n](metrics, **p) for n, p in enabled.items() if n not in shared}
    if shared:
        out["group_rules"] = rules.detect(metrics, [rules.REGISTRY[n](**enabled[n]) for n in shared])
    return out
