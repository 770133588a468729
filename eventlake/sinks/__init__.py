"""Where rows go: message topics, lake tables, files."""
