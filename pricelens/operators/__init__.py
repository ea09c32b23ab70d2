"""Operators: ``f(df, *, column names...) -> DataFrame``, all lazy."""
