"""Queries over the test tables: the library's operators bound to real columns."""
