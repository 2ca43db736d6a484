"""Column expressions. Every function takes and returns Columns; none is a UDF."""
