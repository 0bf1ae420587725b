"""Per-card transaction features, state and model selection as Spark DataFrame operators."""
