"""Readers: landing files, metadata artifacts, stored tables."""
