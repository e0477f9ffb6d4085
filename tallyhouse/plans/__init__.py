"""Marts, suites, reports and runs composed from the operators."""
