"""The lineage repository: registries, analysis batches, impact, reports."""
