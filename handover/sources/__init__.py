"""Readers for the provided tables and the legacy source extracts."""
