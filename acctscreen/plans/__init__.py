"""Composition: the staged pipeline, the query catalog and its SQL twins."""
