"""ordersmith: marketplace order analytics as Spark DataFrame operators.

Subpackages
-----------
functions  scalar cleaning expressions (Column builders)
sources    readers, sinks and the test-table adapter
operators  projections, filters, joins, aggregates, windows
plans      the composite jobs (clean, upsert, marts, audits, vouchers, publish)
streaming  drop-folder ingest with Structured Streaming
"""

__version__ = "0.1.0"
