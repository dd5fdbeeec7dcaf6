"""Operators for building a training corpus: one module each, their queries in ``queries``."""
