"""Composed reports: the spec builder, the shipped enrichment report, batch runs
(run log, summary, status roll-up, KPI refresh) and the spark-submit entry point."""
