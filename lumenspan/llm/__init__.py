"""Operators for training-data corpora.

Nothing else in ``lumenspan`` imports this subpackage; ``__spark_entry__``
adds its queries only when it can be imported.
"""
