"""Composite plans: cleaners, merge, enrichment, the end-to-end run, and the
registered queries over the test tables with their DuckDB oracle SQL."""
