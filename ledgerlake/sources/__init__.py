"""Landed pages, XML rows, the service registry and keyed tables."""
