"""Readers for delimited exports and file manifests."""
