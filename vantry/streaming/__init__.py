"""Incremental and resumable jobs."""
