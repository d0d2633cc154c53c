"""Readers for landed files (CSV, JSON pages, snapshots) and dimensions."""
