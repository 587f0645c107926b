"""Relational operators over pages, regions, tables and document nodes."""
