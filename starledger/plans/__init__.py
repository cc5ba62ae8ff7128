"""Query plans: role views over the driver tables, registered queries
and the end-to-end jobs."""
