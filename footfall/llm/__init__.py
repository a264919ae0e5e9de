"""Operators that prepare text for language models, and their queries."""
