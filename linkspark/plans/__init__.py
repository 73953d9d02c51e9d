"""linkspark.plans."""
