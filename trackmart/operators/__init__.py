"""Relational building blocks (``relational``) and column profiling (``profile``)."""
