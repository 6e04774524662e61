"""Readers (conformed layer) and writers (versioned snapshots)."""
