"""Readers, writers and the views of the given tables that the queries run on."""
