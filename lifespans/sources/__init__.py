"""Readers, writers and normalizers of raw inputs."""
