"""Shift analytics on Spark: what changed on every line in every 12-hour shift.

Everything takes DataFrames and returns DataFrames; no function collects rows
to the driver and none uses a Python UDF.
"""
