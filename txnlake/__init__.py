"""Card-transaction analytics on Spark: validated ingest, star schema, mart, reports."""
