"""Incremental landing of monthly files with Structured Streaming."""
