"""Streaming stages over the same operators as the batch jobs."""
