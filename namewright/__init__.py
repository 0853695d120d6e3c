"""namewright: entity-attribute-value catalogue naming and document export on Spark.

Every public function takes and returns DataFrames (or Columns); no function
creates a session, collects data rows, or loops over rows on the driver.  The
only driver-side data is the naming-rules control table (one row per load set).

Layout
  sources/    scans, decoding, scope and load-set filters
  functions/  column-level helpers (text entries, keys, messages, XML pieces)
  operators/  joins, numbering, per-entity aggregates, rules, name QA, documents
  plans/      the two whole jobs and the run report
  sinks/      staging table, JDBC, document bundles, status snapshots
  streaming/  nothing: the workload is bounded batch only
"""

from namewright.plans.jobs import build_docs, load_set_report, stage_names

__all__ = ["stage_names", "build_docs", "load_set_report"]
