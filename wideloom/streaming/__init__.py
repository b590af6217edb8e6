"""Incremental cell loads with Structured Streaming (see ``cell_log``)."""
