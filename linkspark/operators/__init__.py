"""linkspark.operators."""
