"""Settings by dotted keys, paths relative to the settings file."""

from __future__ import annotations

import json
import os
from typing import Any


def parse(text: str) -> dict:
    """JSON, or the indented ``key: value`` form with scalars."""
    if text.lstrip()[:1] == "{":
        return json.loads(text)
    root: dict = {}
    levels: list[tuple[int, dict]] = [(-1, root)]
    for raw in text.splitlines():
        line = raw.split(" #", 1)[0].rstrip()
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        indent = len(line) - len(line.lstrip())
        key, _, value = line.strip().partition(":")
        while levels[-1][0] >= indent:
            levels.pop()
        if value.strip():
            levels[-1][1][key] = _scalar(value.strip())
        else:
            levels[-1][1][key] = new = {}
            levels.append((indent, new))
    return root


def _scalar(value: str) -> Any:
    if value[:1] in "\"'" and value[-1:] == value[:1]:
        return value[1:-1]
    if value.lower() in ("true", "false", "null", "~"):
        return {"true": True, "false": False}.get(value.lower())
    for kind in (int, float):
        try:
            return kind(value)
        except ValueError:
            continue
    return value


class Config:
    """[IO-17]"""

    def __init__(self, path: str):
        self.folder = os.path.dirname(os.path.abspath(path))
        with open(path, encoding="utf-8") as f:
            self.values = parse(f.read())

    def get(self, key: str, default: Any = None) -> Any:
        value: Any = self.values
        for part in key.split("."):
            if not isinstance(value, dict) or part not in value:
                return default
            value = value[part]
        return value

    def path(self, key: str, default: str = "") -> str:
        value = str(self.get(key, default))
        return value if os.path.isabs(value) else os.path.join(self.folder, value)
