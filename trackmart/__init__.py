"""trackmart: a Spark-native library for building an enriched track table
and profiling the data behind it.

Every public function takes and returns lazy DataFrames (or Columns), so a
whole run is one Catalyst plan: filters and projections reach the scans,
joins and aggregations are planned by Spark (AQE re-plans them from runtime
statistics), and nothing passes through the driver except small scalars
needed to build a plan.

Layout
------
- ``trackmart.schemas``            explicit StructTypes and fixed value sets
- ``trackmart.session``            session defaults and the shared checkpoint folder
- ``trackmart.functions``          Column helpers (null policy, casts, trim, JSON)
- ``trackmart.sources``            CSV / Parquet / catalog / JDBC reads and typed writes
- ``trackmart.operators``          relational building blocks and profiling
- ``trackmart.plans``              cleaners, merge, enrichment, the end-to-end run
- ``trackmart.streaming``          the incremental lookup batch (checkpointed)
"""

__version__ = "0.1.0"
