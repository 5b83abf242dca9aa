"""DataFrame operators: ``(df, **params) -> DataFrame``."""
