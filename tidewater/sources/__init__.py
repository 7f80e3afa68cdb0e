"""Where rows come from: change records, raw files, the calendar."""
