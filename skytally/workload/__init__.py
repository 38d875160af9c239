"""The registered queries and the tables they read."""

from importlib import import_module

_MODULES = ["star_queries", "cube_queries", "question_queries", "quality_queries", "source_queries", "text_queries",
            "stream_queries", "checked_queries"]


def load_all():
    """Import every query module once and return the registry."""
    for name in _MODULES:
        import_module(f"{__name__}.{name}")
    return import_module(f"{__name__}.registry")
