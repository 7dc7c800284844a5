"""The query catalogue: DataFrame plans and their SQL counterparts."""
