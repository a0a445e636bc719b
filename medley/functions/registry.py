"""Checked function registry.

SQL access goes through Spark SQL functions (``CREATE TEMPORARY FUNCTION ...
RETURN expr``): they are inlined into the plan like built-ins and Spark itself
rejects a wrong argument count at analysis (``WRONG_NUM_ARGS``). Spark casts
arguments implicitly (``greet(5)`` is accepted), so the type class check of
the reference is done by :func:`call`, which inspects the resolved schema
before any row is read, and in SQL by the strict form of the functions
(``register_builtins(strict=True)``): its parameters are VARIANT, which keeps the
argument's own type, and the optimizer settles the check of a literal, so that
``SELECT greet(5)`` fails whatever rows it stands over gives out.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from medley.errors import ArgumentCountError, ArgumentTypeError
from medley.functions import scalar

# argument / return classes of the reference's function interface
CLASSES = {
    "STRING": (T.StringType, T.VarcharType, T.CharType),
    "INT": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "REAL": (T.FloatType, T.DoubleType),
    "DECIMAL": (T.DecimalType,),
}
RETURN_TYPES = {"STRING": "STRING", "INTEGER": "BIGINT", "REAL": "DOUBLE",
                "DECIMAL": "DECIMAL(38,18)"}


@dataclass(frozen=True)
class FunctionSpec:
    """U15 return contract plus the argument classes accepted."""
    name: str
    arg_classes: tuple[tuple[str, ...], ...]     # accepted classes per argument
    returns: str                                  # STRING / INTEGER / REAL / DECIMAL
    sql_params: str                               # SQL parameter list
    sql_body: str                                 # SQL RETURN expression
    column: object = field(repr=False, default=None)  # python builder
    maybe_null: bool = True
    constant: bool = False
    arity_message: str = ""


def _specs() -> dict[str, FunctionSpec]:
    s = scalar
    return {
        "hello_world": FunctionSpec(
            "hello_world", (), "STRING", "", f"'{s.HELLO_TEXT}'", s.hello_world,
            maybe_null=False, constant=True,
            arity_message="hello_world() requires no arguments"),
        "helloworld": FunctionSpec(
            "helloworld", (), "STRING", "", f"'{s.HELLO_ALT_TEXT}'", s.hello_world_alt,
            maybe_null=False, constant=True,
            arity_message="helloworld() requires no arguments"),
        "greet": FunctionSpec(
            "greet", (("STRING",),), "STRING", "s STRING",
            f"concat('{s.GREET_PREFIX}', s, '{s.GREET_SUFFIX}')", s.greet,
            arity_message="hello_world requires exactly one string argument"),
        "welcome": FunctionSpec(
            "welcome", (("STRING",),), "STRING", "name STRING",
            f"concat('{s.WELCOME_PREFIX}', name, '{s.WELCOME_SUFFIX}')", s.welcome,
            arity_message="helloworld() requires exactly one string argument (name)"),
    }


SPECS = _specs()


def register(spark: SparkSession, name: str, params: str, returns: str, body: str,
             replace: bool = False, temporary: bool = True) -> None:
    """Register a SQL scalar function. ``returns`` is a reference class
    (STRING, INTEGER, REAL, DECIMAL) or a Spark type. A name that exists is an
    error unless ``replace`` (U13)."""
    rtype = RETURN_TYPES.get(returns.upper(), returns)
    kind = "TEMPORARY FUNCTION" if temporary else "FUNCTION"
    verb = "CREATE OR REPLACE" if replace else "CREATE"
    spark.sql(f"{verb} {kind} {name}({params}) RETURNS {rtype} RETURN {body}")


# variant schemas of each class
_VARIANTS = {"STRING": ("STRING",), "INT": ("BIGINT",), "REAL": ("FLOAT", "DOUBLE"), "DECIMAL": ("DECIMAL",)}


def strict_form(spec: FunctionSpec) -> tuple[str, str]:
    """(parameters, body) of the function with U8 checked in SQL. NULL passes, as in
    ``check_args``: NULL in, NULL out. A value of another class raises the
    function's own message."""
    params, body = [], spec.sql_body
    for param, allowed in zip(filter(None, spec.sql_params.split(",")), spec.arg_classes):
        name, kind = param.split()
        schemas = [v for c in allowed for v in _VARIANTS[c]]
        # a decimal's schema has its precision: compare the name before the bracket
        of = f"regexp_replace(schema_of_variant({name}), '[(].*', '')"
        listed = ", ".join(f"'{v}'" for v in schemas)
        body = (f"CASE WHEN {name} IS NULL OR is_variant_null({name}) THEN NULL WHEN {of} IN ({listed}) "
                f"THEN {re.sub(rf'{chr(92)}b{name}{chr(92)}b', f'CAST({name} AS {kind})', body)} "
                f"ELSE raise_error('{spec.arity_message}') END")
        params.append(f"{name} VARIANT")
    return ", ".join(params), body


def register_builtins(spark: SparkSession, replace: bool = True, strict: bool = False) -> list[str]:
    """Register every function of this package in the session catalog. ``strict``: an
    argument of another class is refused (U8) instead of being cast; that costs a
    look at each value's type."""
    for spec in SPECS.values():
        params, body = strict_form(spec) if strict else (spec.sql_params, spec.sql_body)
        register(spark, spec.name, params, spec.returns, body, replace)
    return list(SPECS)


def drop(spark: SparkSession, name: str, if_exists: bool = False,
         temporary: bool = True) -> None:
    """Drop a function; with ``if_exists`` dropping twice is not an error."""
    kind = "TEMPORARY FUNCTION" if temporary else "FUNCTION"
    spark.sql(f"DROP {kind} {'IF EXISTS ' if if_exists else ''}{name}")


def exists(spark: SparkSession, name: str) -> bool:
    """Look a function up in the session catalog."""
    return spark.catalog.functionExists(name)


def list_registered(spark: SparkSession) -> list[str]:
    """Names of the temporary (session) functions."""
    return sorted(f.name for f in spark.catalog.listFunctions() if f.isTemporary)


def _class_of(dt: T.DataType) -> str | None:
    for cls, types in CLASSES.items():
        if isinstance(dt, types):
            return cls
    return None


def check_args(df: DataFrame, name: str, *args) -> None:
    """U7 + U8: argument count and classes, checked on the resolved schema
    before any row is processed."""
    spec = SPECS[name]
    if len(args) != len(spec.arg_classes):
        raise ArgumentCountError(spec.arity_message)
    if not args:
        return
    resolved = df.select(*[F.col(a) if isinstance(a, str) else a for a in args]).schema
    for i, (f, allowed) in enumerate(zip(resolved.fields, spec.arg_classes)):
        if isinstance(f.dataType, T.NullType):           # NULL in, NULL out, whatever the class
            continue
        cls = _class_of(f.dataType)
        if cls not in allowed:
            raise ArgumentTypeError(
                f"{spec.arity_message}: argument {i + 1} is "
                f"{f.dataType.simpleString()}, expected {' or '.join(allowed)}")


# Aggregate functions are registered separately from scalar ones. A SQL
# function may not contain an aggregate in Spark, so the registry maps a name
# to a Python builder of a native aggregate Column (it stays in the JVM).
_AGGREGATES: dict[str, tuple] = {}


def register_aggregate(name: str, builder, arg_classes=(("INT", "REAL", "DECIMAL"),),
                       replace: bool = False) -> None:
    """Register an aggregate by name; an existing name is an error unless
    ``replace``."""
    if name in _AGGREGATES and not replace:
        raise ValueError(f"aggregate function {name} already exists")
    _AGGREGATES[name] = (builder, tuple(arg_classes))


def drop_aggregate(name: str, if_exists: bool = False) -> None:
    if name not in _AGGREGATES:
        if if_exists:
            return
        raise ValueError(f"no aggregate function {name}")
    del _AGGREGATES[name]


def aggregate(df: DataFrame, name: str, *args) -> Column:
    """Checked call of a registered aggregate: count and classes are checked
    on the resolved schema before any row is read."""
    if name not in _AGGREGATES:
        raise ValueError(f"no aggregate function {name}")
    builder, classes = _AGGREGATES[name]
    if len(args) != len(classes):
        raise ArgumentCountError(f"{name}() requires exactly {len(classes)} argument(s)")
    resolved = df.select(*[F.col(a) if isinstance(a, str) else a for a in args]).schema
    for f, allowed in zip(resolved.fields, classes):
        if _class_of(f.dataType) not in allowed:
            raise ArgumentTypeError(f"{name}() does not accept {f.dataType.simpleString()}")
    return builder(*args)


def _register_default_aggregates() -> None:
    from medley.operators.median import median_col
    register_aggregate("my_median", median_col, replace=True)


_register_default_aggregates()


def call(df: DataFrame, name: str, *args) -> Column:
    """Checked call: validate, then return the native column expression."""
    check_args(df, name, *args)
    return SPECS[name].column(*args)


__all__ = ["register", "register_builtins", "drop", "exists", "list_registered",
           "check_args", "call", "SPECS", "FunctionSpec", "CLASSES", "register_aggregate",
           "drop_aggregate", "aggregate"]
