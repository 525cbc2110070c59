"""Readers and writers: warehouse tables, snapshots, files, table definitions, databases."""
