"""Readers of the tables and of the line stream."""
