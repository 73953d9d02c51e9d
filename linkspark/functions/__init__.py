"""linkspark.functions."""
