"""eventlens.plans."""
