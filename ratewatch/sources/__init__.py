"""Where rows come from and go to: lines, messages, tables, and the test events."""
