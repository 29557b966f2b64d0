"""Readers, writers, generators and stream sources."""
