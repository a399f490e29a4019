"""Structured Streaming: landing packets and correcting acquisitions as they become complete."""
