"""Where rows come from: files and the views over the test tables."""
