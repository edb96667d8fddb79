"""Scans: driver tables, landed JSON documents, typed CSV, self-describing dumps."""

from tallysheet.sources.tables import TABLES, Tables, table

__all__ = ["TABLES", "Tables", "table"]
