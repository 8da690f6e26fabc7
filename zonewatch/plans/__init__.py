"""Complete jobs: the batch load, the report, and the registered queries with their SQL twins."""
