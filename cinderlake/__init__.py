"""Cinderlake: a star-schema warehouse for incident snapshots, written for Spark."""
