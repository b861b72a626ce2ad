"""Readers and writers: encrypted files, tables, evaluation sets."""
