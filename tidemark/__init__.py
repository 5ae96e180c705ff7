"""Keyed, windowed and event-time analytics as DataFrame functions on Spark."""
