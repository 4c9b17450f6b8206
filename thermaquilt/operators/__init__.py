"""Relational and grid operators."""
