"""Sinks: landed documents, typed CSV, dumps, payload batches, versioned tables."""
