"""Registered queries over the provided tables, each with its oracle statement."""
