"""Readers and writers, and documents rendered from tables."""
