"""Query plans: the registered queries and their reference SQL."""
