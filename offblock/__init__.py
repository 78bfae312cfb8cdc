"""offblock — taxi-out analytics as Spark DataFrame jobs.

Sub-packages:
  sources    file scans/sinks and the driver-table adapter (flights, weather, geography)
  functions  column expressions (text, datetime, geo, numeric)
  operators  DataFrame -> DataFrame operators (joins, traffic, encode, impute, split, ...)
  ml         model fitting, search, scoring and attribution on Spark ML
  plans      the stage chains: silver, gold, train, predict
"""

__version__ = "0.1.0"
