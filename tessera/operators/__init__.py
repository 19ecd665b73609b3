"""DataFrame -> DataFrame operators: summaries, dedup, keyed, top-k, quality, policy."""
