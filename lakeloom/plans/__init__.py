"""Dimensions, facts, marts, views, reconciliation, and the queries over the driver's tables."""
