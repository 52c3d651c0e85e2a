"""kpiloom: incentive and KPI reporting on Spark DataFrames.

Sub-packages
------------
sources     readers, catalog registration and sinks
functions   Column-level helpers (key/number normalisation, tiers, formats, search)
operators   DataFrame operators (filters, joins, measures, latest-per-key, merge, rules)
plans       composed reports (spec builder, shipped report, batch runs, run log)
streaming   refresh-on-arrival with Structured Streaming
"""

from kpiloom.session import checkpoint_dir, get_session, scratch_path  # noqa: F401

__all__ = ["get_session", "checkpoint_dir", "scratch_path"]
