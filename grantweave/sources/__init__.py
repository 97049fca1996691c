"""Reading yearly CSV sources, and writing and reading stage tables."""
