"""Where rows come from: topics, replayed topic files and schema snapshots."""
