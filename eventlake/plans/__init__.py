"""End-to-end jobs, each a composition of sources, operators and sinks."""
