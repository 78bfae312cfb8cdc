"""Models on Spark ML: feature prep, search, fit, score, attributions."""
