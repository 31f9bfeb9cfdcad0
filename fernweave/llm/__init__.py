"""Operators of a training-data pipeline. Nothing else in the library imports this package.

Modules are imported one by one where needed, so that a Python worker loads
only the operator it runs.
"""
