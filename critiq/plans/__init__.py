"""Plans: the orchestrated job, reports, and the registered queries."""
