"""Queries over the given tables, their independent SQL, and the inputs both share."""
