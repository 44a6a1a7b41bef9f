"""Column expressions shared by the models.  Everything here is built from
``pyspark.sql.functions`` so that it stays inside whole-stage code generation."""

from marketloom.functions.arrays import unnest_zip
from marketloom.functions.buckets import BRAZIL_STATES, ladder, ranges, state_name
from marketloom.functions.numbers import (
    cents,
    from_cents,
    guarded_corr,
    mean,
    mean_over_all,
    money,
    pct,
    ratio,
    sample_stddev,
    total,
    weighted_mean,
    weighted_mean_micros,
)
from marketloom.functions.text import initcap_words, month_label, pad_zip, surrogate_key
from marketloom.functions.time import day_diff, epoch_diff, micros_between, month_start, to_seconds

__all__ = [
    "BRAZIL_STATES",
    "cents",
    "day_diff",
    "epoch_diff",
    "from_cents",
    "guarded_corr",
    "initcap_words",
    "ladder",
    "mean",
    "mean_over_all",
    "micros_between",
    "money",
    "month_label",
    "month_start",
    "pad_zip",
    "pct",
    "ranges",
    "ratio",
    "sample_stddev",
    "state_name",
    "surrogate_key",
    "to_seconds",
    "total",
    "unnest_zip",
    "weighted_mean",
    "weighted_mean_micros",
]
