"""Number formats, schedules and limits used around training logs."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(value: Column, digits: int = 4) -> Column:
    """``%.{digits}f``. DecimalFormat rounds on the exact binary value, as C printf does;
    ``format_string`` rounds the shortest decimal half up and differs on ties."""
    return F.call_function("format_number", value, F.lit("0." + "0" * digits))


def scientific(value: Column, digits: int = 2) -> Column:
    """``%.{digits}e``."""
    text = F.call_function("format_number", value, F.lit("0." + "0" * digits + "E00"))
    return F.regexp_replace(F.replace(text, F.lit("E-"), F.lit("e-")), "E", "e+")


def metric_line(step: Column, loss: Column, rate: Column, label: str = "loss") -> Column:
    """``Step 10: loss=8.5000, lr=1.35e-06``; a missing rate prints as zero, a missing loss gives null."""
    return F.concat(
        F.lit("Step "), step.cast("string"), F.lit(f": {label}="), fixed(loss, 4),
        F.lit(", lr="), scientific(F.coalesce(rate, F.lit(0.0)), 2),
    )


def loss_or_missing(loss: Column) -> Column:
    """Four digits, or ``N/A`` when there is no loss yet."""
    return F.coalesce(fixed(loss, 4), F.lit("N/A"))


def learning_rate(step: Column, base: float = 3e-4, warmup: int = 2000, total: int = 11838) -> Column:
    """Linear warmup to ``base``, then a half cosine down to zero at ``total``. The factor is formed
    first and then multiplied with ``base``: another order gives other last digits."""
    s = step.cast("double")
    progress = (s - F.lit(float(warmup))) / F.lit(float(max(1, total - warmup)))
    decay = F.greatest(F.lit(0.0), F.lit(0.5) * (F.lit(1.0) + F.cos(F.lit(math.pi) * progress)))
    return F.when(s < warmup, F.lit(base) * (s / F.lit(float(max(1, warmup))))).otherwise(F.lit(base) * decay)


def epoch(step: Column, steps_per_epoch: int = 5919, digits: int = 4) -> Column:
    return F.round(step.cast("double") / F.lit(float(steps_per_epoch)), digits)


def clamp_length(value: Column, upper: int = 300) -> Column:
    return F.least(value, F.lit(upper))


def clamp_temperature(value: Column, lower: float = 0.1) -> Column:
    return F.greatest(value, F.lit(lower))


def megabytes(size: Column, binary: bool = False) -> Column:
    """Bytes as MB: of 1e6 bytes, or of 1024 * 1024."""
    return size.cast("double") / F.lit(1048576.0 if binary else 1e6)
