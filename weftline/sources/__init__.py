"""Tables, their columns, and definitions."""
