"""Readers and writers for the case-file layouts, and stand-in inputs."""
