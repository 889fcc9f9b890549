"""Operators for preparing training text at corpus scale.

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds
its queries when the subpackage is present. Each module holds one operator with
a general interface; ``queries`` derives the registered ``opN_*`` results from
them.
"""
