"""Plans over several operators: the whole engine, and the queries over star-schema tables."""
