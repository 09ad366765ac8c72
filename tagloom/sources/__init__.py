"""Readers for captured messages and relational tables."""
