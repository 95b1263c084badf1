"""Readers and writers: CSV landing, enrichment cache, tables, exports."""
