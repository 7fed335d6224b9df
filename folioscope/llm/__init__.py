"""Operators for preparing training data: deduplication, tokenising, sharding,
mixing, scoring, chat formatting and exact search.  Nothing else in the package
imports this folder."""
