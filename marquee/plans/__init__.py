"""Chains of operators and the registered queries."""
