"""Whole workloads (flights, births, bids, temperatures) and the registered queries."""
