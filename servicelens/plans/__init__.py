"""Query plans: the registered queries, their SQL oracles and the full run."""
