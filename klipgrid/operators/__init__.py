"""Relational operators: identity, ranking, skew, intervals, joins, gates."""
