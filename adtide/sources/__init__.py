"""Readers of landed reports, layered table storage and seed data."""
