"""Relational operators on changelogs and snapshots."""
