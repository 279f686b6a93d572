"""Variant-annotation analytics as functions from DataFrame to DataFrame."""
