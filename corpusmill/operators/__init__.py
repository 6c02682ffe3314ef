"""Operators of the reference pipeline: DataFrame -> DataFrame."""
