"""Structured Streaming form of the area-hour job."""
