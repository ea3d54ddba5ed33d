"""Readers, writers and the review views over a table folder."""
