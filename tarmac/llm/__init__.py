"""Operators for preparing training text at scale.

Each module holds one operator with a general interface (``docs`` plus column names and
parameters); ``queries`` binds them to the registered tables. Nothing outside this
subpackage imports it.
"""
