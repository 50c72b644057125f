"""Compositions of operators into end-to-end jobs, and the registered queries."""
