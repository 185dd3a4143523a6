"""The published tables, each one lazy plan over operators.

Sheets are DataFrames of text columns with ``_ord``, the order of their lines.
"""
