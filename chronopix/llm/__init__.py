"""Training-data operators: search, deduplication, counting, scoring, filtering and mixing of documents."""
