"""Column-level helpers and the shared building blocks."""
