"""Training-data operators: ten document operators and the queries that apply them."""
