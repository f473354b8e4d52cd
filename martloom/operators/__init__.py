"""Operators on DataFrames: columns, filters, joins, order, quality checks, loads."""
