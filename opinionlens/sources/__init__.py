"""Readers and record extraction."""
