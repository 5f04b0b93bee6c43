"""Query plans: fixture views, landed inputs, registered queries, jobs."""
