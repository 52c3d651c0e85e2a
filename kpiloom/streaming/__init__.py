"""Refresh on arrival: file-source stream, per-batch partials, totals, compaction."""
