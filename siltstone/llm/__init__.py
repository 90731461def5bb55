"""Operators for preparing training text at scale.

Each module holds one operator with its own general interface; ``queries``
registers the thin ``opN_*`` queries over them.  Nothing outside this
subpackage imports it.
"""
