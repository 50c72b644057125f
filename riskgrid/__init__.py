"""riskgrid: leakage-safe regional event forecasting on Spark DataFrames."""

__version__ = "0.1.0"
