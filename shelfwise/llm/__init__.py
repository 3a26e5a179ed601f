"""Training-data operators: one module each, their queries in ``queries``; nothing else in the library imports them."""
