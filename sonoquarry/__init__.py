"""Speech-corpus curation on Spark."""
