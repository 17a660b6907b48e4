"""Ratios and segments shared by the consume models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; zero or NULL denominators give NULL."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def share_pct(part: Column, whole: Column, decimals: int = 2) -> Column:
    return F.round(
        part.cast("double") * F.lit(100.0) / F.nullif(whole.cast("double"), F.lit(0.0)), decimals
    )


def bucket(value: Column, limits: list[tuple[float, str]], default: str) -> Column:
    """Label of the first lower limit that the value reaches; limits run from high to low."""
    expr = None
    for limit, label in limits:
        test = value >= F.lit(limit)
        expr = F.when(test, F.lit(label)) if expr is None else expr.when(test, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def market_quadrant(
    population: Column, rate: Column, median_population: Column, p25: Column, p75: Column
) -> Column:
    """Market size against penetration."""
    # The labels of the published table.
    large = population >= median_population
    return (
        F.when(large & (rate >= p75), F.lit("Vaca lechera"))
        .when(large & (rate < p25), F.lit("Gigante dormido"))
        .when((population < median_population) & (rate >= p75), F.lit("Nicho fiel"))
        .otherwise(F.lit("Sin foco"))
    )


def potential_revenue(
    rate: Column, national_rate: Column, population: Column, national_ticket: Column
) -> Column:
    """Extra revenue of a place below the national rate if it reached that rate."""
    gain = (national_rate - rate) * population * national_ticket
    return F.when(rate < national_rate, F.round(gain, 2)).otherwise(F.lit(0.0))


def dropped(current: Column, previous: Column, threshold: float = -0.20) -> Column:
    """True when the relative change against the previous value reaches the threshold."""
    change = (current - previous) / F.nullif(previous, F.lit(0.0))
    return F.coalesce((previous > 0) & (change <= F.lit(threshold)), F.lit(False))


def change_pct(current: Column, previous: Column) -> Column:
    change = (current - previous) / F.nullif(previous, F.lit(0.0)) * 100
    return F.when(previous > 0, F.round(change, 2))
