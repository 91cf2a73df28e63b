"""Jobs, dashboard queries, and the operators bound to the driver tables."""
