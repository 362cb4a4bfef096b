"""Changelog readers and the derived test inputs."""
