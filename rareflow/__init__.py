"""Spark jobs for labelled, rare-event transaction tables."""
