"""linkspark.sources."""
