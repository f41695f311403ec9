"""Snapshot files, warehouse tables and synthetic incidents."""
