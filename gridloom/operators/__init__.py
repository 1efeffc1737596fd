"""Operators on DataFrames: registry, checks, folding, quarantine, control tables, bulk loads."""
