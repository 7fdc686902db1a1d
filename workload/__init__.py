"""The engine's queries over the sample tables, each with an independent SQL statement."""
