"""Batch sinks; streaming sinks live in ``txflow.streaming``."""
