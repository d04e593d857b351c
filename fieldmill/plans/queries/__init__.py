"""Registered queries, one module per theme. Importing this package registers all of them."""

from fieldmill.plans.queries import bids, births, cleaning, files, flights, grouping, nested

__all__ = ["bids", "births", "cleaning", "files", "flights", "grouping", "nested"]
