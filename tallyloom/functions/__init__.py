"""Column builders. Everything here is a composition of built-in Spark functions."""
