"""Bounded and continuous runs of streaming DataFrames."""
