"""Errors of the table layer."""


class TableError(Exception):
    """Base of all."""


class OptionError(TableError):
    """An option is unknown, missing or has a bad value."""


class BindError(TableError):
    """A file's column can't become the declared type."""


class UnsupportedType(TableError):
    """A file's type has no table type."""
