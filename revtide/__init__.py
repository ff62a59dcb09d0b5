"""Revision-aware time series on Spark: change logs, vintages, quality control, table upkeep."""
