"""Functions over columns and statements."""
