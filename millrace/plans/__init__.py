"""Warehouse and mart models, analyses and the registry that orders them."""
