"""Operators for large training-data pipelines.

Each module holds one operator; ``queries`` applies them to the driver's
tables.  Nothing outside this subpackage imports it, apart from the guarded
registration in ``__spark_entry__.py``.
"""
