"""Table stores, loaders for the license tables, and writers."""
