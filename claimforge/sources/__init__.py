"""Scene-graph sources, shard sink and reports."""
