"""Market-tick analytics as Spark jobs: bars, rolling means, serving, facts, models."""
