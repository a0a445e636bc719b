"""Error classes raised before any row is processed (analysis-time checks)."""


class MedleyError(Exception):
    """Base class."""


class ArgumentCountError(MedleyError):
    """A function was called with the wrong number of arguments."""


class ArgumentTypeError(MedleyError):
    """A function argument has a type class the function does not accept."""


class NoSuchTableError(MedleyError):
    """The table name is not registered or its data file does not exist."""


class CorruptTableError(MedleyError):
    """The data file exists but cannot be read as Parquet."""


class ReadOnlyTableError(MedleyError):
    """Writes to a bound Parquet table are refused."""
