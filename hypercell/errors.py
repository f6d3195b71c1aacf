"""Errors that the library raises by itself."""


class InvalidTable(ValueError):
    """A table, descriptor or request that makes no sense."""


class NotSupported(NotImplementedError):
    """Something that is left out on purpose."""
