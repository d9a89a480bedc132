"""docspark: documents to validated, scored records, as Spark DataFrame jobs."""

__version__ = "0.1.0"
