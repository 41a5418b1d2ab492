"""Readers, writers and the views over the event table."""
