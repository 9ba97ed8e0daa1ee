"""tickwise: a Spark-native batch engine for daily market prices and macro series.

Every public function takes and returns DataFrames; nothing is collected to the
driver inside an operator.  Layout:

* ``functions``  column-expression helpers (rounding, guarded parsing, redaction)
* ``sources``    table readers, landed-payload parsing, fixtures, sinks
* ``operators``  normalisation, staging, windows, joins, upsert, audit, quality, reads
* ``plans``      mart compositions, the full build, and the query registry
* ``streaming``  file-triggered ingestion with Structured Streaming
"""

__version__ = "0.1.0"
