"""Operators for preparing training data at scale.

One module per operator; ``queries`` registers one query per operator over the
driver's tables. Nothing else in the library imports this subpackage.
"""
