"""Queries over the fixture tables, by section of the inventory."""
