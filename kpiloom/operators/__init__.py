"""DataFrame operators: payout merge (consolidate), paging, filters, joins and the
slab range join, latest-per-key, measures, dashboard, scheme rules."""
