"""Operators for building language-model training data at scale.

Nothing else in the library imports this subpackage; its queries are added by
``__spark_entry__`` only when it can be imported.
"""
