"""Column expressions. Everything here is a built-in Catalyst expression; there is no Python UDF."""
