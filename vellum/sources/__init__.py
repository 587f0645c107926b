"""Readers that turn raw documents into rows."""
