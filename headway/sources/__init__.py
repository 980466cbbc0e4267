"""Readers and writers: schedule and traffic feeds, the corridor dimension, result tables."""
