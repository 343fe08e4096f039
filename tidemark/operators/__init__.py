"""Relational operators: filters, batches, joins, aggregates, windows."""
