"""wordspan: word-level text-provenance data preparation on Spark."""
