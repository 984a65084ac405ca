"""Scalar function plug-ins (V01): functions of columns registered by name, for use wherever a function query stands.

A function takes and returns Columns, so it is planned by Catalyst like the built-in ones; ``aggregate`` functions of the caller's own, pandas
UDFs and SQL expressions all fit. Names are case-insensitive and cannot be registered twice by accident.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_FUNCTIONS: dict[str, tuple[Callable[..., Column], int | None]] = {}


def register_function(name: str, fn: Callable[..., Column], arity: int | None = None, replace: bool = False) -> None:
    """Make ``fn`` known as ``name``; ``arity``: the number of arguments it takes (None: any)."""
    key = name.lower()
    if key in _FUNCTIONS and not replace:
        raise ValueError(f"function {name!r} is registered already")
    _FUNCTIONS[key] = fn, arity


def unregister_function(name: str) -> None:
    _FUNCTIONS.pop(name.lower(), None)


def call(name: str, *args) -> Column:
    """A registered function of columns: strings name columns, other values are literals."""
    try:
        fn, arity = _FUNCTIONS[name.lower()]
    except KeyError:
        raise ValueError(f"unknown function {name!r}; known: {sorted(_FUNCTIONS)}") from None
    if arity is not None and len(args) != arity:
        raise ValueError(f"{name} takes {arity} arguments, not {len(args)}")
    return fn(*[a if isinstance(a, Column) else F.col(a) if isinstance(a, str) else F.lit(a) for a in args])
