"""Operators for preparing training text, each a DataFrame-to-DataFrame function.

Nothing outside this package imports it. ``queries`` registers one query per
operator; the operators keep their own, wider interfaces.
"""
