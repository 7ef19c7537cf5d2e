"""Filters, unnesting, sub-document updates."""
