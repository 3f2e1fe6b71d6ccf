"""Air-quality expressions. All are native Column expressions, so they stay in generated code."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra import rules

Field = Callable[[str], Column]


def fields_of(df: DataFrame) -> Field:
    """How to reach a measurement: in the ``measurements`` struct of a message, else a flat column."""
    if "measurements" in df.columns:
        return lambda name: F.col(f"measurements.{name}")
    return F.col


def aqi_category(pm2_5: Column) -> Column:
    """Air-quality class of a pm2.5 value; NaN compares above every bound."""
    category = F.when(pm2_5.isNull(), rules.AQI_MISSING)
    for upper, label in rules.AQI_UPPER_BOUNDS:
        category = category.when(pm2_5 <= upper, label)
    return category.otherwise(rules.AQI_ABOVE)


def heat_index(temperature: Column, humidity: Column) -> Column:
    weighted = temperature * rules.HEAT_INDEX_TEMPERATURE + humidity * rules.HEAT_INDEX_HUMIDITY
    return F.round(weighted, 2)


def is_anomaly(field: Field) -> Column:
    """True when any measurement is above its threshold; NULL measurements do not decide."""
    return reduce(or_, [field(name) > limit for name, limit, _ in rules.ANOMALY_THRESHOLDS])


def anomaly_reason(field: Field) -> Column:
    """The first threshold passed, in rule order; the last rule is what remains."""
    *ranked, (_, _, remaining) = rules.ANOMALY_THRESHOLDS
    first, *rest = ranked
    reason = F.when(field(first[0]) > first[1], first[2])
    for name, limit, label in rest:
        reason = reason.when(field(name) > limit, label)
    return reason.otherwise(remaining)


def severity(field: Field) -> Column:
    critical = reduce(or_, [field(name) > limit for name, limit in rules.CRITICAL_THRESHOLDS])
    return F.when(critical, rules.SEVERITY_CRITICAL).otherwise(rules.SEVERITY_WARNING)


def is_labelled(label: Column) -> Column:
    """Truth label as boolean: producers send true, 'true' or 'True'; a missing label is not true."""
    return F.coalesce(F.lower(label) == "true", F.lit(False))
