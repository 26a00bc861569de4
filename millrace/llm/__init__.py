"""Operators on training text: cut, near-equal, defective, residual, leaked, shared and packed texts."""
