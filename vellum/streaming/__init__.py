"""Stateful streaming operators."""
