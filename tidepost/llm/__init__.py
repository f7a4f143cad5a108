"""Operators for preparing training data: one module per operator, its queries in ``queries``."""
