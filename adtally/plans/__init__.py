"""Complete jobs, and the queries over the test tables with their SQL twins."""
