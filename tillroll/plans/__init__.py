"""Composed jobs: the cube, the weekly refresh, and the named query registry."""
