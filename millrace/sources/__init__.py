"""Readers, writers and materialized tables."""
