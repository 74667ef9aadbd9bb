"""Operators over DataFrames: rules, integrity, keys, profiles, synthesis."""
