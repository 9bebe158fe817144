"""Plans from raw documents to query results."""
