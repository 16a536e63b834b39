"""meterlake: a cloud-usage cost lakehouse expressed as Spark DataFrame and Structured Streaming jobs.

Layers: landing -> bronze -> silver (valid / quarantined) -> gold marts -> keyed serving tables.
Every function takes and returns DataFrames or Columns; there are no Python UDFs.
"""
