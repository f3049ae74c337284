"""Compositions of operators: the end-to-end flow and the registered queries."""
