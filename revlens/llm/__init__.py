"""Operators for large-scale training-data pipelines.

One module per operator; ``queries`` registers the thin ``opN_<name>`` queries
and the pipeline.  Nothing outside this sub-package imports it, except the
guarded lookup in ``__spark_entry__``.
"""
