"""Stored results: tables that are updated in place, and one-document text sinks."""
