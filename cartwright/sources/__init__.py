"""Reading: raw CSV files, file listings, generated series, the given tables as entities."""
