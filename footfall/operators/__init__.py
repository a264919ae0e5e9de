"""Reusable table operators, written as compositions of DataFrame operations."""
