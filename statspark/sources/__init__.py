"""Landed inputs."""
