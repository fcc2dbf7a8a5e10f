"""Operators of a training-data pipeline (extraction, de-duplication, mixing, ...).

Nothing outside this subpackage imports it.
"""
