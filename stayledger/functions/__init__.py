"""Column expressions. Everything here is a Spark built-in; there are no Python UDFs."""
