"""Operators on training text.  Nothing outside this folder imports them."""
