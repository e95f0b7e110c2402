"""Errors that a caller can tell apart; the command line turns them into exit code 2."""


class EngineError(Exception):
    """Base of all errors raised on purpose."""


class DataError(EngineError):
    """Input, configuration or target isn't what it must be."""
