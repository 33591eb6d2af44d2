"""DataFrame operators: dedup, lookups, planning, time lookup, quality, writing."""
