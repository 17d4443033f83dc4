"""Data products and the query catalog."""
