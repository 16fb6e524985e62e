"""Intentionally empty.

The analysed workload has no streams, watermarks, windows over event time or
stateful operators; its only incremental idea (reusing a cached weather table)
is the batch job :func:`revlens.sources.weather.materialize_or_reuse`.
"""
