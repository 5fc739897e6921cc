"""refloom: biomedical reference-data compilation as Spark DataFrame jobs."""
