"""Readers: text, JSON and image-header records to rows."""
