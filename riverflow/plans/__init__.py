"""Compositions: the refresh pipelines and the registered query catalog."""
