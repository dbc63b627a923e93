"""Readers, writers and the adapter that turns the star-schema tables into trips."""
