"""Workflows and the registered query catalog (see ``catalog.QUERIES``)."""
