"""Sources and sinks."""

from riskgrid.sources.tables import TABLES, events, read_table, standin_catalog  # noqa: F401
