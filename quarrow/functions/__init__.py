"""Column functions with the source dialect's meaning where Spark's differs."""

from .columns import bpchar, bytea_text, epoch_days, epoch_micros, interval_parts, numeric_text, time_of_day, time_micros

__all__ = ["bpchar", "bytea_text", "epoch_days", "epoch_micros", "interval_parts", "numeric_text", "time_micros", "time_of_day"]
