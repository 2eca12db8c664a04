"""Relational operators that Spark's SQL lacks or names differently."""
