"""Registered queries over the given tables, and the SQL each is compared with."""
