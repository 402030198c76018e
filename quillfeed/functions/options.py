"""Strict options on the driver: values are checked once, before any job starts."""

from __future__ import annotations

import datetime
import math
import re
from collections.abc import Iterable, Sequence

MAX_SAFE = 2**53 - 1


def integer(value: object, name: str, default: int | None = None, least: int = 0, most: int = MAX_SAFE) -> int:
    """A whole number, also as a text of digits, within bounds; an absent value is the default."""
    if value is None:
        if default is None:
            raise ValueError(f"{name} is required")
        return default
    text = value.strip() if isinstance(value, str) else value
    if isinstance(text, bool) or not (isinstance(text, int) or isinstance(text, str) and re.fullmatch(r"-?[0-9]+", text)):
        raise ValueError(f"{name} must be a whole number: {value!r}")
    number = int(text)
    if not least <= number <= most:
        raise ValueError(f"{name} must lie between {least} and {most}: {number}")
    return number


def number(value: object, name: str, default: float | None = None, least: float = 0.0, most: float = math.inf) -> float:
    """A finite number within bounds."""
    if value is None:
        if default is None:
            raise ValueError(f"{name} is required")
        return default
    try:
        found = math.nan if isinstance(value, bool) else float(value)
    except (TypeError, ValueError):
        found = math.nan
    if not math.isfinite(found) or not least <= found <= most:
        raise ValueError(f"{name} must be a number between {least} and {most}: {value!r}")
    return found


def date(value: str, name: str = "date") -> str:
    """A real calendar date, strictly YYYY-MM-DD."""
    if not re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", value or ""):
        raise ValueError(f"{name} must be YYYY-MM-DD: {value!r}")
    datetime.date.fromisoformat(value)
    return value


def user(value: object, default: str = "") -> str:
    """A user id of digits only."""
    text = str(value or default)
    if not re.fullmatch(r"[0-9]+", text):
        raise ValueError("user id must be digits")
    return text


def parse(arguments: Sequence[str], allowed: Iterable[str], booleans: Iterable[str] = ()) -> dict[str, str | bool]:
    """`--name value`, `--name=value` and flags; unknown names, repeated ones and stray words are refused."""
    known, flags, out, at = {*allowed}, {*booleans}, {}, 0
    while at < len(arguments):
        word = arguments[at]
        if not word.startswith("--"):
            raise ValueError(f"unexpected argument: {word}")
        name, equals, value = word[2:].partition("=")
        if name not in known:
            raise ValueError(f"unknown option: --{name}")
        if name in out:
            raise ValueError(f"repeated option: --{name}")
        following = arguments[at + 1] if at + 1 < len(arguments) else None
        if name in flags:
            if not equals and following in ("true", "false"):
                value, at = following, at + 1
            if value not in ("", "true", "false"):
                raise ValueError(f"--{name} takes true or false")
            out[name] = value != "false"
        elif equals:
            out[name] = value
        elif following is None or following.startswith("--"):
            raise ValueError(f"--{name} needs a value")
        else:
            out[name], at = following, at + 1
        at += 1
    return out
