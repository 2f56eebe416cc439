"""Checkpointed jobs that drain what is available and exit."""
