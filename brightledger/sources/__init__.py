"""Readers, writers, load policies, generators and versioned tables."""
