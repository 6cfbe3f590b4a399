"""retaloom: a retail medallion, star-schema, KPI and forecasting engine on Spark."""

__version__ = "0.1.0"
