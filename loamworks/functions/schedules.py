"""Training arithmetic as column expressions: horizons, batch sizes, schedules, throughput."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reference batch size, the power of its growth, momentum levels and warm-up steps.
BATCH_REF, BATCH_POWER = 2**19, 0.383
MOMENTUM_LOW, MOMENTUM_HIGH, MOMENTUM_END, MOMENTUM_WARMUP = 0.85, 0.97, 0.90, 400


def batch_size(tokens: Column, tokens_ref: Column) -> Column:
    """The power of two nearest to the batch size that the horizon asks for."""
    return F.pow(F.lit(2.0), F.rint(F.log2(BATCH_REF * F.pow(tokens / tokens_ref, F.lit(BATCH_POWER))))).cast("long")


def rate_scale(batch: Column) -> Column:
    return F.sqrt(batch / BATCH_REF)


def weight_decay_scale(batch: Column, tokens: Column, tokens_ref: Column) -> Column:
    return F.sqrt(batch / BATCH_REF) * (tokens_ref / tokens)


def rate_multiplier(step: Column, steps: int, warmup: int, warmdown_ratio: float, final: float) -> Column:
    """Linear warm-up, level, linear warm-down to ``final``."""
    down = round(warmdown_ratio * steps)
    left = (steps - step) / max(down, 1)
    out = F.when(step <= steps - down, 1.0).otherwise(left + (1 - left) * final)
    return F.when(step < warmup, (step + 1) / warmup).otherwise(out) if warmup else out


def momentum(step: Column, steps: int, warmdown_ratio: float) -> Column:
    down = round(warmdown_ratio * steps)
    up, part = step / MOMENTUM_WARMUP, (step - (steps - down)) / max(down, 1)
    return (
        F.when(step < MOMENTUM_WARMUP, (1 - up) * MOMENTUM_LOW + up * MOMENTUM_HIGH)
        .when(step >= steps - down, MOMENTUM_HIGH * (1 - part) + MOMENTUM_END * part)
        .otherwise(MOMENTUM_HIGH)
    )


def weight_decay(step: Column, steps: int, start: float) -> Column:
    return start * 0.5 * (1 + F.cos(F.pi() * step / steps))
