"""Temperature, rain and crop expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rimeframe import fixed_values as fv


def plausible_temperature(degrees: Column) -> Column:
    """The reading itself when it lies in the physical envelope (inclusive), else NULL."""
    low, high = fv.TEMPERATURE_RANGE_C
    return F.when(degrees.between(low, high), degrees)


def non_negative(amount: Column) -> Column:
    return F.when(amount >= 0, amount)


def contradicts(tmin: Column, tmax: Column) -> Column:
    """True only when both are known and the minimum exceeds the maximum."""
    return F.coalesce(tmin > tmax, F.lit(False))


def midpoint(a: Column, b: Column) -> Column:
    return (a + b) / F.lit(2.0)


def is_frost(tmin: Column) -> Column:
    """Three-valued: NULL for an unknown minimum."""
    return tmin <= F.lit(fv.FROST_AT_OR_BELOW_C)


def is_heat_stress(tmax: Column) -> Column:
    return tmax >= F.lit(fv.HEAT_STRESS_AT_OR_ABOVE_C)


def growing_degrees(tavg: Column, base_c: float, missing_as_zero: bool = False) -> Column:
    """Degrees above the crop base, never below zero.

    An unknown temperature gives NULL.  ``missing_as_zero`` counts it as zero growth instead,
    which is what a bare ``greatest(0, NULL)`` would do.
    """
    grown = F.greatest(F.lit(0.0), tavg - F.lit(base_c))
    return grown if missing_as_zero else F.when(tavg.isNotNull(), grown)


def enso_phase(anomaly: Column) -> Column:
    limit = fv.ENSO_PHASE_LIMIT
    return (
        F.when(anomaly <= -limit, "nina")
        .when(anomaly >= limit, "nino")
        .when(anomaly.isNotNull(), "neutral")
    )


def rain_class(rain_mm: Column) -> Column:
    """Name of the rain class, upper limits inclusive; NULL rain has no class."""
    return _rain_class(rain_mm, [label for _, label in fv.RAIN_CLASSES])


def rain_class_rank(rain_mm: Column) -> Column:
    """Position of the class, for ordering."""
    return _rain_class(rain_mm, list(range(len(fv.RAIN_CLASSES))))


def _rain_class(rain_mm: Column, names: list) -> Column:
    limits = [limit for limit, _ in fv.RAIN_CLASSES]
    chain = F.when(rain_mm <= limits[0], F.lit(names[0]))
    for limit, name in zip(limits[1:-1], names[1:-1]):
        chain = chain.when(rain_mm <= limit, F.lit(name))
    return chain.when(rain_mm.isNotNull(), F.lit(names[-1]))


def frost_rule(tmin: Column, threshold_c: float = fv.FROST_RULE_C) -> Column:
    """1.0 when today is cold enough to expect frost; an unknown minimum predicts 0.0."""
    return F.when(tmin <= F.lit(threshold_c), F.lit(1.0)).otherwise(F.lit(0.0))
