"""Readers and writers: raw files, model tables, reports."""
