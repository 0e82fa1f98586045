"""Operators over DataFrames: counts, quality checks, tokenization, profiles, audit records."""
