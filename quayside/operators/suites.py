"""Expectation suites as data: lists of calls, or the nested form by expectation name."""

from __future__ import annotations

import ast
import json
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

PREFIX = "expect_"
_CALL = re.compile(r"^\s*(\w+)\s*\((.*)\)\s*$", re.S)


@dataclass(frozen=True)
class Expectation:
    name: str
    column: str | None = None
    args: tuple = ()
    error: str | None = None

    @property
    def args_text(self) -> str:
        return json.dumps(list(self.args))


def _named(name: str) -> str:
    return name if name.startswith(PREFIX) else PREFIX + name


def _flat(args) -> tuple:
    """Bounds may be given one by one or as one list: both mean the same."""
    return tuple(args[0]) if len(args) == 1 and isinstance(args[0], (list, tuple)) else tuple(args)


def from_call(text: str) -> Expectation:
    """``expect_x('column', 1, 10)``; arguments are literals and are never run."""
    found = _CALL.match(text)
    if not found:
        return Expectation(text, error="not an expectation call")
    name, inside = _named(found[1]), found[2].strip()
    try:
        args = ast.literal_eval(f"({inside},)") if inside else ()
    except (SyntaxError, ValueError):
        return Expectation(name, error="arguments are not literals")
    if name.startswith(f"{PREFIX}table_"):
        return Expectation(name, None, _flat(args))
    if not args or not isinstance(args[0], str):
        return Expectation(name, error="no column")
    return Expectation(name, args[0], _flat(args[1:]))


def from_nested(suite: Mapping) -> Iterator[Expectation]:
    """``{name: {"columns": [column, [args], ...]}}`` and ``{name: {"values": [...]}}``."""
    for name, body in suite.items():
        if not isinstance(body, Mapping):
            yield Expectation(str(name), error="neither a list nor a table of checks")
            continue
        if "values" in body:
            yield Expectation(_named(name), None, tuple(body["values"]))
            continue
        columns = body.get("columns")
        if columns is None:  # a title around the suite
            yield from from_nested(body)
            continue
        for at, item in enumerate(columns):
            if isinstance(item, str):
                follows = columns[at + 1] if at + 1 < len(columns) else None
                yield Expectation(_named(name), item, tuple(follows) if isinstance(follows, list) else ())
            elif not (isinstance(item, list) and at and isinstance(columns[at - 1], str)):
                yield Expectation(_named(name), error=f"entry {at + 1} of columns is neither a name nor the bounds behind one")


def read_suite(suite) -> list[Expectation]:
    """Any served form, or its JSON text, as expectations. A suite is tens of items."""
    if isinstance(suite, str):
        suite = json.loads(suite)
    if isinstance(suite, Mapping):
        nested = {k: v for k, v in suite.items() if not isinstance(v, list)}
        listed = [item for v in suite.values() if isinstance(v, list) for item in v]
        return [*read_suite(listed), *from_nested(nested)]
    return [item if isinstance(item, Expectation) else from_call(item) for item in suite]
