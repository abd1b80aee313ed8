"""DataFrame operators: filters, lookups, aggregates, keys, upsert, quality, set operations."""
