"""Text enrichment of tables and streams on Spark."""
