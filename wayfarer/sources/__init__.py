"""Readers and writers: CSV feeds, spec imports, folder import, fixtures."""
