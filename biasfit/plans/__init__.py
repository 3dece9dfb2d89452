"""Composite plans: the end-to-end pipeline, the query catalog and its SQL twins."""
