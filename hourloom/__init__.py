"""Hourly panel analytics on Spark: one row per series and hour, many signals."""
