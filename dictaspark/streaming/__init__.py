"""Streaming forms: resumable append, and event-time windows as an extension."""
