"""Risk factors as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logwarden import rules
from logwarden.common import ladder, lookup, round_1


def band(score: Column, scale: str = "risk") -> Column:
    return ladder(score, rules.BANDS[scale])


def brute_force_score(attempts: Column) -> Column:
    return round_1(F.least(attempts * F.lit(2.0), F.lit(10.0)))


def port_scan_score(attempts: Column, ports: Column) -> Column:
    return round_1(F.least(attempts * F.lit(0.3) + ports * F.lit(0.5), F.lit(10.0)))


def anomaly_score(mean_score: Column, count: Column) -> Column:
    return round_1(F.least(F.abs(mean_score) * 5 + count * F.lit(1.5), F.lit(10.0)))


def history_score(recent: Column, old: Column, types: Column) -> Column:
    variety = F.when(types > 1, types * F.lit(1.5)).otherwise(F.lit(0.0))
    return F.least(recent * F.lit(2.0) + old * F.lit(0.5) + variety, F.lit(10.0))


def frequency_score(same_type_24h: Column) -> Column:
    column = None
    for upper, score in rules.FREQUENCY_STEPS:
        hit = same_type_24h <= upper
        column = F.when(hit, F.lit(score)) if column is None else column.when(hit, F.lit(score))
    return column.otherwise(F.lit(rules.FREQUENCY_TOP))


def time_score(ts: Column) -> Column:
    hour = F.hour(ts)
    night = F.when((hour >= 22) | (hour <= 6), F.lit(1.5)).otherwise(F.lit(0.0))
    weekend = F.when(F.weekday(ts) >= 5, F.lit(1.0)).otherwise(F.lit(0.0))
    return night + weekend


def geo_score(country_code: Column) -> Column:
    """Country risk; an address the table does not know counts 1."""
    return (
        F.when(country_code.isin(rules.GEO_HIGH_RISK), F.lit(3.0))
        .when(country_code.isin(rules.GEO_MEDIUM_RISK), F.lit(1.5))
        .when(country_code.isNull() | (country_code == rules.UNKNOWN_PLACE[4]), F.lit(1.0))
        .otherwise(F.lit(0.0))
    )


def severity_multiplier(threat_type: Column) -> Column:
    return lookup(threat_type, rules.SEVERITY_MULTIPLIERS, 1.0)


def weighted_score(base, history, geo, time, frequency, multiplier, weights=rules.RISK_WEIGHTS) -> Column:
    total = (
        base * F.lit(weights["base"])
        + history * F.lit(weights["history"])
        + geo * F.lit(weights["geo"])
        + time * F.lit(weights["time"])
        + frequency * F.lit(weights["frequency"])
    )
    return F.least(total * multiplier, F.lit(10.0))
