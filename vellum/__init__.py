"""Vellum: document analytics on Spark. Pages, regions, tables, nodes and chunks are plain DataFrames."""
