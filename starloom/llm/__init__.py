"""Operators for preparing training text at cluster scale; nothing else in the package imports this."""
