"""Choose columns by name or type, or with a small formula.

A selector is a function from a schema to column names; ``-selector`` removes
names and ``a | b`` joins two selections.  ``resolve`` applies a mixed list of
names and selectors from left to right.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import types as T

# The types that count as numeric and as nominal.
NUMERIC_TYPES = ("float", "double", "smallint", "int", "bigint")
NOMINAL_TYPES = ("string",)


class Selector:
    """A set of columns described by a rule."""

    def __init__(self, pick: Callable[[T.StructType], list[str]], negative: bool = False):
        self._pick = pick
        self.negative = negative

    def names(self, schema: T.StructType) -> list[str]:
        return self._pick(schema)

    def __neg__(self) -> "Selector":
        return Selector(self._pick, not self.negative)

    def __or__(self, other: "Selector") -> "Selector":
        return Selector(lambda schema: list(dict.fromkeys(self.names(schema) + other.names(schema))))

    def __and__(self, other: "Selector") -> "Selector":
        return Selector(lambda schema: [n for n in self.names(schema) if n in other.names(schema)])


def _by_name(test: Callable[[str], bool]) -> Selector:
    return Selector(lambda schema: [f.name for f in schema.fields if test(f.name)])


def has_type(*types: str) -> Selector:
    """Columns whose Spark type name (``int``, ``string``, ...) is one of ``types``."""
    return Selector(lambda schema: [f.name for f in schema.fields if f.dataType.simpleString() in types])


def all_numeric() -> Selector:
    return has_type(*NUMERIC_TYPES)


def all_nominal() -> Selector:
    return has_type(*NOMINAL_TYPES)


def starts_with(prefix: str, ignore_case: bool = True) -> Selector:
    fold = str.lower if ignore_case else str
    return _by_name(lambda n: fold(n).startswith(fold(prefix)))


def ends_with(suffix: str, ignore_case: bool = True) -> Selector:
    fold = str.lower if ignore_case else str
    return _by_name(lambda n: fold(n).endswith(fold(suffix)))


def contains(text: str, ignore_case: bool = True) -> Selector:
    fold = str.lower if ignore_case else str
    return _by_name(lambda n: fold(text) in fold(n))


def matches(pattern: str, ignore_case: bool = True) -> Selector:
    compiled = re.compile(pattern, re.IGNORECASE if ignore_case else 0)
    return _by_name(lambda n: compiled.search(n) is not None)


def num_range(prefix: str, numbers: Sequence[int], width: int | None = None) -> Selector:
    wanted = [prefix + (str(n).zfill(width) if width else str(n)) for n in numbers]
    return Selector(lambda schema: [n for n in wanted if n in schema.names])


def one_of(*names: str) -> Selector:
    return Selector(lambda schema: [n for n in names if n in schema.names])


def everything() -> Selector:
    return _by_name(lambda n: True)


def resolve(schema: T.StructType, terms) -> list[str]:
    """Names meant by ``terms``: a name, ``-name``, a selector, or a list of these.

    A list that opens with a removal starts from all columns.
    """
    items = [terms] if isinstance(terms, (str, Selector)) else list(terms)
    chosen: dict[str, None] = {}
    for position, item in enumerate(items):
        if isinstance(item, Selector):
            names, remove = item.names(schema), item.negative
        else:
            remove = item.startswith("-") and item not in schema.names
            name = item[1:] if remove else item
            if name not in schema.names:
                raise ValueError(f"no column named {name!r}; there are {schema.names}")
            names = [name]
        if remove:
            if position == 0:
                chosen = dict.fromkeys(schema.names)
            for n in names:
                chosen.pop(n, None)
        else:
            chosen.update(dict.fromkeys(names))
    return list(chosen)


def parse_formula(formula: str, columns: Sequence[str]) -> tuple[list[str], str | None]:
    """``"y ~ a + b"`` to ``(["a", "b"], "y")``.

    ``.`` stands for every column other than the response and ``- z`` leaves one
    out.  A formula here selects columns; it does not compute with them.
    """
    left, tilde, right = formula.partition("~")
    if not tilde:
        raise ValueError(f"not a formula: {formula!r}")
    response = left.strip().strip("`") or None
    if response is not None and response not in columns:
        raise ValueError(f"response {response!r} is not a column")
    chosen: dict[str, None] = {}
    pieces = re.findall(r"([+-]?)\s*(`[^`]+`|[^\s+\-`]+)", right)
    if not pieces or re.sub(r"[+-]?\s*(`[^`]+`|[^\s+\-`]+)", "", right).strip():
        raise ValueError(f"cannot read the right side of {formula!r}")
    for sign, term in pieces:
        name = term.strip("`")
        if term == ".":
            names = [c for c in columns if c != response]
        elif name in columns:
            names = [name]
        else:
            raise ValueError(f"{term!r} in {formula!r} is not a column; only '+', '-' and '.' are understood")
        for n in names:
            if sign == "-":
                chosen.pop(n, None)
            else:
                chosen[n] = None
    return list(chosen), response
