"""Unlimited check of answer bodies that the built-in parser refuses."""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import LAYER_NAMES

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

TOKEN = re.compile(
    r'[ \t\n\r]*(?:([{}\[\],:])|("(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*+")'
    r'|(-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?|true|false|null)|(\Z))')
ENTRIES = "array<struct<key:string,value:string>>"


def object_entries(text: str, wanted: tuple[str, ...] = LAYER_NAMES, raw: bool = False) -> list[tuple[str, str | None]] | None:
    """``(key, value as JSON text)`` of the wanted keys of a JSON object; None unless the text is one.

    A stack of open brackets instead of recursion, so depth and size have no limit. ``null`` is None, a string is
    without its quotes unless ``raw``.
    """
    at, stack, expect, entries, key, begin = 0, [], "object", [], None, 0
    while True:
        m = TOKEN.match(text, at)
        if not m:
            return None
        mark, string, scalar, _ = m.groups()
        start, at = (m.start(m.lastindex), m.end()) if m.lastindex else (at, m.end())
        if m.lastindex == 4:
            return entries if expect == "end" else None
        if expect == "object" and mark != "{":
            return None
        done = False
        if expect in ("key", "key or close") and string:
            if len(stack) == 1:
                key = json.loads(string)
            expect = "colon"
        elif expect == "colon" and mark == ":":
            expect = "value"
        elif expect in ("value", "value or close", "object") and (string or scalar or mark in ("{", "[")):
            if len(stack) == 1:
                begin = start
            if mark in ("{", "["):
                stack.append(mark)
                expect = "key or close" if mark == "{" else "value or close"
            else:
                done = True
        elif mark == "}" and stack and stack[-1] == "{" and expect in ("key or close", "comma or close") or (
                mark == "]" and stack and stack[-1] == "[" and expect in ("value or close", "comma or close")):
            stack.pop()
            done = True
        elif mark == "," and expect == "comma or close":
            expect = "key" if stack[-1] == "{" else "value"
        else:
            return None
        if done:
            if len(stack) == 1 and key in wanted and stack[0] == "{":
                value = text[begin:at].strip(" \t\n\r")
                entries.append((key, None if value == "null" else plain(value) if value.startswith('"') and not raw else value))
            expect = "comma or close" if stack else "end"


def plain(string: str) -> str:
    """The text of a JSON string; half a surrogate pair, which no encoding can hold, becomes ``?`` as in the built-in parser."""
    return json.loads(string).encode("utf-8", "replace").decode()


def shallow(node: str | None) -> str | None:
    """A node with its own two fields alone, so that what else it holds meets no limit later."""
    if node is None or not node.startswith("{"):
        return node
    return "{" + ",".join(f'"{k}":{v}' for k, v in object_entries(node, ("name", "chemont_id"), raw=True) or [] if v is not None) + "}"


def checked_answer(body: Column) -> Column:
    """Entries of the five keys, or NULL unless the body is one JSON object; NULL bodies cost nothing."""
    def entries(text: str | None):
        got = None if text is None else object_entries(text)
        return None if got is None else [{"key": k, "value": shallow(v)} for k, v in got]

    def check(bodies: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in bodies:
            yield series.map(entries)

    check.__annotations__ = {"bodies": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(check, ENTRIES)(body)
