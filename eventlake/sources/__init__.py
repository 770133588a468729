"""Where rows come from: message topics, generated rows, delimited files."""
