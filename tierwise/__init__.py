"""Risk scoring for imbalanced binary targets, expressed as Spark DataFrame operators."""
