"""The warehouse SQL dialect: tokens, syntax trees, and column lineage of one statement."""
