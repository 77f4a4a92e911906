"""Column expressions; all of them are built-in functions, none is a UDF."""
