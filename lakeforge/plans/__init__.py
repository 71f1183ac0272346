"""Query plans: BI set, Silver loads, Gold builders, layered run, ML, and
the registry of queries with their SQL oracles."""
