"""Readers for tables, streams and job parameters."""
