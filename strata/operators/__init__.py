"""Relational operators of the lake (rules, silver shaping, contract, gold, quality, marts)."""
