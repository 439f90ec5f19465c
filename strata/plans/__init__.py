"""Plans: the pipeline, SQL forms, and the query catalogue."""
