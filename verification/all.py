"""Importing this module registers every query."""

from verification import bars, edges, features, feed, quality, ticks  # noqa: F401
