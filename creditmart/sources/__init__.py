"""Readers, writers and the table schemas of the datamart."""
