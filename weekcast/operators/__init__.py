"""Reusable DataFrame operators (series windows, packing, search, models, ...)."""
