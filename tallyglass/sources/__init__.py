"""Readers, writers and the backlog of unprocessed inputs."""
