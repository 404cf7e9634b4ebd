"""Question families, quality rules, generated tables, scores and training data as Spark plans."""
