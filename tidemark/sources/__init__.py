"""Typed sources."""
