"""Training-data pipeline operators, one module each.

Nothing else in the package imports this folder. ``REGISTRY`` and ``ORACLES``
in ``queries`` hold the registered queries and their SQL.
"""
