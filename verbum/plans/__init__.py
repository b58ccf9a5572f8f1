"""Compositions of the operators: whole tasks and the registered query catalog."""
