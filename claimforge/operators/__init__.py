"""DataFrame operators: normalization, pools, planning, generation, validation, deduplication."""
