"""Relational operators of the sales cube, built from DataFrame primitives."""
