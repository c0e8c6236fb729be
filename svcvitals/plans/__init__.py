"""Composed plans: the view stack, registered queries and their SQL oracle."""
