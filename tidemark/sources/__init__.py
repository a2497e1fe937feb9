"""Batch and streaming sources."""
