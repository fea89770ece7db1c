"""Exceptions raised by the library."""


class EntityFrameError(Exception):
    """Common base of every error below."""


class SchemaError(EntityFrameError):
    """A schema, a value or a write request does not fit the declared contract."""


class KeyValidationError(EntityFrameError):
    """A key is malformed, incomplete where it must not be, or repeated."""


class QueryValidationError(EntityFrameError):
    """A restricted scan breaks one of the query rules."""


class DerivedFrameWriteError(EntityFrameError):
    """A frame whose rows no longer match its source is written to that source."""


class WriteConflictError(EntityFrameError):
    """Another writer committed the same table version first."""


class WriteFailedError(EntityFrameError):
    """A report holds failed rows and the caller asked to be told."""
