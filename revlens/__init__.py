"""revlens: review-satisfaction analytics as Spark DataFrame jobs.

Every job is a plain function ``(DataFrame, ..., params) -> DataFrame`` that
Catalyst can optimise end to end.  Sub-packages:

* ``sources``   - JSON-in-CSV scans, extraction filters, weather feeds, sinks
* ``functions`` - column expressions (parsers, cleaners, buckets, rounding)
* ``operators`` - feature, enrichment, descriptive, screening, sampling and
                  metric jobs
* ``plans``     - Spark ML estimators and the evaluation / comparison jobs
* ``streaming`` - intentionally empty (the analysed workload has no streams)
"""

from revlens.session import get_session, ensure_checkpoint_dir  # noqa: F401
