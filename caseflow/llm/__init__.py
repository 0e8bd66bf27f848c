"""Training-data operators: filters, joins, scoring, packing and token files.

Nothing else in the package imports this subpackage; its queries are in ``queries``.
"""
