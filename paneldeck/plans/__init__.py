"""Bindings of the driver tables to panel concepts and the query catalogue."""
