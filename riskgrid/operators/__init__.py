"""DataFrame -> DataFrame operators (filters, joins, aggregates, windows, split, prep, metrics, guards)."""
