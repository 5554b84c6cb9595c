"""Readers, derived input tables and writers."""
