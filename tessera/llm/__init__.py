"""Operators for preparing language-model training data at corpus scale.

Each module holds one operator with a general interface. ``entries`` has the
thin registered queries (``opN_<name>``) and their SQL. Nothing else in the
library imports this subpackage.
"""
