"""Where rows come from: stored tables, export files and the subject registry."""
