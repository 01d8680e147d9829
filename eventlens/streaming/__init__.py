"""eventlens.streaming."""
