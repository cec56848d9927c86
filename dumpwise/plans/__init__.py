"""Plans: join helpers, daily report jobs (load -> report -> sink) and the query registry."""
