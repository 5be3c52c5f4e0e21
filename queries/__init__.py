"""Queries over the derived layers, each with the SQL that must give the same rows."""
