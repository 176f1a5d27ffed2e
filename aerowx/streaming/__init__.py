"""Structured Streaming form of the window attach."""
