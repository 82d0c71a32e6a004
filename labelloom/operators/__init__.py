"""Operators on question frames ``(id, title, body, tags)`` and on what is derived from them."""
