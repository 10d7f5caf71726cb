"""Checks: the registered queries, their oracle SQL, and the fixture records they run on."""
