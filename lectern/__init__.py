"""Learning analytics on Spark: landing, upserts, rollups, metrics, quality, cost and search."""
