"""Operators for preparing language-model training data on Spark.

Nothing else in the package imports this subpackage; its queries are in
``queries`` and join ``__spark_entry__.queries()`` only where it is present.
"""
