"""Snapshots as a stream of files."""
