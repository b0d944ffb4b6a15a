"""Models over bars, as Spark ML pipelines."""
