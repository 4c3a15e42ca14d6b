"""Incremental (Structured Streaming) form of the weekly demand aggregate."""
