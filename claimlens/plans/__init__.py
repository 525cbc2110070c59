"""Composed queries: the two extracts, preparation and the anomaly model."""
