"""Running streams: triggers, and per-batch appends to lake tables."""
