"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it. ``queries`` and ``oracles`` hold
the registered queries; every other module is one operator.
"""
