"""Registered queries (``registry.QUERIES``) and their oracle SQL (``registry.ORACLES``)."""
