"""Operators for preparing training data at corpus scale; see the README's table."""
