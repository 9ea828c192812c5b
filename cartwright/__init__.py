"""cartwright: commerce-order analytics expressed as Spark DataFrame operators.

Every public operator is a ``DataFrame -> DataFrame`` (or ``Column``) function,
so Catalyst and adaptive execution plan the whole chain; the few that must run
a job while they are built (a checkpoint, a write, a CSV's header) say so.
Sub-packages:

- ``sources``   typed / tolerant readers, schema registry, test-table adapter
- ``functions`` column-expression builders (safe parsing, exact rounding, ...)
- ``operators`` cleaning, aggregation, joins, windows, profiling, quality
- ``plans``     compositions: master table, analytics view, reports, insights
- ``sinks``     parquet / csv / json writers and the report writer
"""

from cartwright.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
