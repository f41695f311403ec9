"""Whole jobs: marts over the star schema, the layered load, snapshot growth."""
