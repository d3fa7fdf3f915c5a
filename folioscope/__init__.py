"""Text-quality analytics on Spark: documents to scored, classified and aggregated lines."""
