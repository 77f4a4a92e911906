"""Operators on any DataFrame of the right shape; keys and columns are arguments."""
