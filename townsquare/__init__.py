"""Review lakehouse and star schema as plain Spark DataFrame transformations.

Layers: landing files -> bronze (raw) -> silver (clean) -> gold (star schema)
-> reports. Every transformation takes and returns lazy DataFrames; only the
sinks and the streaming ingest start jobs.
"""
