"""Relational operators over change logs, snapshots and history."""
