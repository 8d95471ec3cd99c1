"""Operators of a training-data pipeline: archives, cleaning, near copies, mixing, models and tokens.

Nothing outside this package imports it.
"""
