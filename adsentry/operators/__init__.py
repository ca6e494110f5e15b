"""Analytics operators: each is ``fn(df, **params) -> DataFrame`` over native expressions."""
