"""eventlens.sources."""
