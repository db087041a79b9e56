"""Operators of a training-data pipeline, one module each, with their queries.

``registry.QUERIES`` lists the contract queries; nothing outside this
subpackage imports it except the guarded lookup in ``__spark_entry__``.
"""
