"""Media-metadata and time-aligned text analytics on Spark."""
