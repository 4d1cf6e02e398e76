"""Column expressions; each is built from Spark's own functions, none is a UDF."""
