"""Multi-operator flows and the query catalogue."""
