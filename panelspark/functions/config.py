"""Job configuration: comment keys and required keys."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

COMMENT_SUFFIX = "_comment"


def without_comments(value: Any) -> Any:
    """Drop the keys that end in the comment suffix, at every level."""
    match value:
        case dict():
            return {k: without_comments(v) for k, v in value.items() if not k.endswith(COMMENT_SUFFIX)}
        case list() | tuple():
            return type(value)(map(without_comments, value))
    return value


def check_keys(section: dict, keys: Iterable[str], name: str) -> None:
    missing = [k for k in keys if k not in section]
    if missing:
        raise KeyError(f"section {name} misses {', '.join(missing)}")
