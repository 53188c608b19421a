"""Column expressions, named transforms and guarded/retrying row maps."""
