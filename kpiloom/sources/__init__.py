"""Readers, catalog and sinks: tables, CSV / folder / JSON / inline / HTML sources,
the scheme sheet, sheet views and KPI SQL, report / append / CSV / run-log /
workspace sinks."""
