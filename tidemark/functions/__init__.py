"""Column functions (no UDFs): keys, geometry, type conversion, lookups."""
