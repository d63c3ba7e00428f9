"""Operators of a large-scale training-data pipeline.

Each module holds one operator with its own general interface; ``queries``
applies them to the given tables and derives the digest columns.  Nothing
outside this subpackage imports it (``__spark_entry__`` adds its queries only
when it is present).
"""
