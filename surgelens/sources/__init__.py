"""Readers, writers, catalog entries and persisted baselines."""
