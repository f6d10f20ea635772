"""Registered queries: each library operator on the given tables, with the SQL that must give the same rows."""
