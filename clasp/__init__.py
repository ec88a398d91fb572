"""clasp: labelled-text and tabular classification analytics on Spark.

Operators are plain ``DataFrame -> DataFrame`` functions grouped by kind:

* ``clasp.sources``   typed scans, sinks, model artifacts
* ``clasp.operators`` projections, filters, joins, aggregates, top-k, time buckets
* ``clasp.functions`` column-expression helpers (rounding, type guessing, hashing, tokens)
* ``clasp.ml``        Spark ML feature pipelines, forests, splits, scoring
* ``clasp.streaming`` Structured Streaming decode / validate / score / sink
* ``clasp.plans``     the composed read-side and job plans over the driver tables
"""

__version__ = "0.1.0"
