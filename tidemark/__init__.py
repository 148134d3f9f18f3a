"""Feature engineering on Spark DataFrames: windows, as-of joins, snapshots, drift, embeddings."""
