"""Readers and writers for tables, JSON pages and HTML pages."""
