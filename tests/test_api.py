"""The package root exports the main entry points."""

import tillroll


def test_exports():
    for name in tillroll.__all__:
        assert callable(getattr(tillroll, name)), name
