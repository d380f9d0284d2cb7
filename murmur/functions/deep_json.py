"""Reply trees nested deeper than a recursive JSON parser takes, by one scan of the text."""

from __future__ import annotations

import json
import re
import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOKEN = re.compile(
    r'[ \t\n\r]*(?:("(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*")'
    r"|([{}\[\],:])|(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null)(?![0-9A-Za-z.+-]))"
)
BLANK = re.compile(r"[ \t\n\r]*")
# What an open object or list is, seen from the root: a comment, its "replies", their "data",
# the list of "children", one child, or anything else.
COMMENT, REPLIES, DATA, CHILDREN, CHILD, OTHER = range(6)
# Which member leads from one to the next.
INSIDE = {(COMMENT, "replies"): REPLIES, (REPLIES, "data"): DATA, (DATA, "children"): CHILDREN, (CHILD, "data"): COMMENT}
WANTED = ("id", "parent_id", "body")
OPENING = {"{": "}", "[": "]"}


VALUE, FIRST_VALUE, KEY, FIRST_KEY, AFTER = range(5)


class _Malformed(ValueError):
    pass


class _Open:
    """An object or list whose end has not come yet."""

    __slots__ = ("kind", "mark", "start", "member", "comment")

    def __init__(self, kind: int, mark: str, start: int):
        self.kind, self.mark, self.start = kind, mark, start
        self.member: str | None = None
        self.comment: dict | None = {"start": start} if kind == COMMENT else None

    def inner(self, mark: str) -> int:
        """What an object or list is that is the next value here."""
        if self.mark == "[":
            return CHILD if self.kind == CHILDREN and mark == "{" else OTHER
        kind = INSIDE.get((self.kind, self.member), OTHER)
        return kind if (kind == CHILDREN) == (mark == "[") else OTHER

    def note(self, value: str | None) -> None:
        if self.kind == COMMENT and self.member in WANTED:
            self.comment[self.member] = value


def comments_of(payload: str | None) -> list[dict] | None:
    """id, parent_id, body, start, end of every comment of a reply tree, parents first,
    replies in order; start and end mark the comment's own JSON in `payload`. None if it is
    not JSON.

    The open objects are on a stack of their own, so depth costs nothing, and each character
    is looked at once. Of members that are not text the JSON is given; null is None.
    """
    if payload is None:
        return None
    found: list[dict] = []
    try:
        end = _scan(payload, found)
    except _Malformed:
        return None
    if BLANK.match(payload, end).end() != len(payload):
        return None
    return [
        {"id": c.get("id"), "parent_id": c.get("parent_id"), "body": c.get("body"), "start": c["start"], "end": c["end"]}
        for c in found
    ]


def _scan(payload: str, found: list[dict]) -> int:
    """Adds the comments of the value that `payload` begins with and returns its end."""
    stack: list[_Open] = []
    at, due = 0, VALUE
    while True:
        token = TOKEN.match(payload, at)
        if token is None:
            raise _Malformed
        text, mark, plain = token.groups()
        start, at = token.start(token.lastindex), token.end()
        if due in (KEY, FIRST_KEY) and text is not None:
            colon = TOKEN.match(payload, at)
            if colon is None or colon.group(2) != ":":
                raise _Malformed
            stack[-1].member = _string(text)
            at, due = colon.end(), VALUE
            continue
        if due in (VALUE, FIRST_VALUE) and mark in OPENING:
            top = _Open(stack[-1].inner(mark) if stack else COMMENT if mark == "{" else OTHER, mark, start)
            if top.comment is not None:
                found.append(top.comment)
            stack.append(top)
            due = FIRST_KEY if mark == "{" else FIRST_VALUE
            continue
        if due == AFTER and mark == ",":
            due = KEY if stack[-1].mark == "{" else VALUE
            continue
        if due in (VALUE, FIRST_VALUE) and mark is None:
            if stack:
                stack[-1].note(_string(text) if text is not None else None if plain == "null" else plain)
        elif due in (AFTER, FIRST_KEY, FIRST_VALUE) and stack and OPENING.get(stack[-1].mark) == mark:
            closed = stack.pop()
            if closed.comment is not None:
                closed.comment["end"] = at
            if stack:
                stack[-1].note(payload[closed.start : at] if stack[-1].member in WANTED else None)
        else:
            raise _Malformed
        if not stack:
            return at
        due = AFTER


def _string(text: str) -> str:
    value = json.loads(text)
    if "\\u" in text:  # halves of a pair that stand alone are no text
        value = value.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    return value
