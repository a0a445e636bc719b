"""Scalar column functions (U1-U6, U9) as native column expressions.

Every function is a ``concat`` / literal expression, so it stays inside
whole-stage codegen, is constant-folded when it can be, and propagates NULL
(``concat`` returns NULL if any input is NULL; ``concat_ws`` / ``coalesce``
would not).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The texts the functions return.
HELLO_TEXT = "Hello World from UDF!"
HELLO_ALT_TEXT = "Hello World Mysql Plugin-UDF"
GREET_PREFIX = "Hello World, "
GREET_SUFFIX = "!"
WELCOME_PREFIX = "Welcome "
WELCOME_SUFFIX = ", HelloWorld Mysql Plugin"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def hello_world() -> Column:
    """Constant text, no argument."""
    return F.lit(HELLO_TEXT)


def hello_world_alt() -> Column:
    """Constant text, never NULL, constant-folded."""
    return F.lit(HELLO_ALT_TEXT)


def greet(col) -> Column:
    """U4: 'Hello World, <s>!'; NULL in, NULL out; no length limit."""
    return F.concat(F.lit(GREET_PREFIX), _c(col), F.lit(GREET_SUFFIX))


def welcome(col) -> Column:
    """U5/U6: 'Welcome <s>, HelloWorld Mysql Plugin'; NULL in, NULL out; UTF-8."""
    return F.concat(F.lit(WELCOME_PREFIX), _c(col), F.lit(WELCOME_SUFFIX))


def coerce(col, type_class: str) -> Column:
    """Convert an argument to the requested class, as the host does when a
    function asks for STRING / INT / REAL / DECIMAL."""
    target = {"STRING": "string", "INT": "bigint", "REAL": "double",
              "DECIMAL": "decimal(38,18)"}[type_class.upper()]
    return _c(col).cast(target)


__all__ = ["hello_world", "hello_world_alt", "greet", "welcome", "coerce",
           "HELLO_TEXT", "HELLO_ALT_TEXT"]
