"""linkspark.streaming."""
