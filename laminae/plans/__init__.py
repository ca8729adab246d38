"""Composed jobs: the layered run, the star schema and the registered queries."""
