"""CRM extracts to analysis-ready mart tables, as Spark DataFrame operators."""

__version__ = "0.1.0"
