"""Incremental flows."""
