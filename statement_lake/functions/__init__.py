"""Column expressions: typed text values and content fingerprints."""
