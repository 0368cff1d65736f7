"""Plans: the feeds, the multi-feed run and the query registry."""
