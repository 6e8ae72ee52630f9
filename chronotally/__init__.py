"""Batch and streaming roll-ups of timestamped records, written for Spark."""
