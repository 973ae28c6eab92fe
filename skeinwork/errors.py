"""Errors that callers can tell apart."""


class Unsupported(NotImplementedError):
    """The operation is known and has no counterpart here; it never falls back silently."""


class NoElement(LookupError):
    """An element operator found no row, or more than the one asked for."""
