"""Import every module that registers queries (see ``ingot.registry``)."""

from .plans import bronze, enrich, governance, monitor, silver  # noqa: F401
