"""Telemetry analytics over Spark DataFrames."""
