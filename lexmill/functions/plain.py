"""The few functions that need a loop to a fixpoint or a parser, as plain Python that workers import."""

from __future__ import annotations

import difflib
import json
import re
from collections import deque

from lexmill.functions.text import AND_PATTERN, PARENS, VERSION_PATTERN

_SPACE = re.compile(r"\s+")
_PAREN = re.compile(PARENS)
_VERSION = re.compile(VERSION_PATTERN)
_AND = re.compile(AND_PATTERN)


def plain_normalize(value: str) -> str:
    return _SPACE.sub(" ", value.strip().lower())


def plain_key(value: str) -> str:
    return plain_normalize(value.translate(str.maketrans("-_", "  ")))


def plain_acronym(value: str) -> str:
    return "".join(w[0] for w in re.findall(r"[a-zA-Z0-9]+", value)).lower()


def _acronym_like(value: str) -> bool:
    letters = [c for c in value if c.isalpha()]
    return 2 <= len(value) <= 12 and all(c.isalpha() or c.isdigit() for c in value) and len(letters) >= 2 and all(c.isupper() for c in letters)


def without_acronym_suffix(value: str, canonical: str) -> str:
    """[FN-12] Drop "(CANON)" or " CANON" from the end as long as the rest spells the acronym."""
    name = re.escape(canonical)
    endings = [re.compile(rf"\s*\(\s*{name}\s*\)\s*$", re.I), re.compile(rf"\s+{name}\s*$", re.I)]
    value = value.strip()
    changed = True
    while changed and value:
        changed = False
        for ending in endings:
            rest = ending.sub("", value).strip()
            if rest and rest != value and plain_acronym(rest) == plain_normalize(canonical):
                value, changed = rest, True
                break
    return value


def alias_text(alias: str, canonical: str) -> str:
    """[FN-13] Hyphens and underscores as blanks, without the canonical's own acronym."""
    value = _SPACE.sub(" ", alias.translate(str.maketrans("-_", "  "))).strip()
    if value and _acronym_like(canonical.strip()):
        value = without_acronym_suffix(value, canonical.strip())
    found = _PAREN.search(value)
    if found:
        base, inner = _PAREN.sub("", value).strip(), found.group(1).strip()
        if base and inner and plain_normalize(inner) == plain_acronym(base) != "":
            value = base
    return _SPACE.sub(" ", value).strip()


def _parts(value: str) -> list[str]:
    for sign, cut in (("/", lambda v: v.split("/")), (None, _AND.split), (",", lambda v: v.split(","))):
        if (sign is None and _AND.search(plain_normalize(value))) or (sign is not None and sign in value):
            parts = [p.strip() for p in cut(value) if p.strip()]
            clean = all(len(p) >= 2 and not any(c in p for c in "/,()") and not _AND.search(plain_normalize(p)) for p in parts)
            return parts if len(parts) >= 2 and clean and len({plain_normalize(p) for p in parts}) == len(parts) else []
    return []


def atomic_aliases(alias: str, canonical: str) -> list[str]:
    """[CJ-08] An alias taken apart, breadth first, until no part can be split safely."""
    todo, seen, out = deque([alias_text(alias, canonical)]), set(), []
    while todo:
        value = todo.popleft().strip()
        if not value or plain_key(value) in seen:
            continue
        seen.add(plain_key(value))
        parts = _parts(value)
        if parts:
            todo.extend(alias_text(p, canonical) for p in parts)
        else:
            out.append(value)
    return out


def clean_aliases(aliases: list[str] | None, canonical: str) -> list[str]:
    """[CJ-09, ST-02] Atomic aliases without the canonical itself and without repeats, sorted by normalised text."""
    kept: dict[str, str] = {}
    for alias in aliases if aliases is not None else []:
        for value in atomic_aliases(str(alias), canonical):
            kept.setdefault(plain_key(value), value)
    kept.pop(plain_key(canonical), None)
    kept.pop("", None)
    return sorted(kept.values(), key=plain_normalize)


def lenient_json(text: str | None):
    """[FN-37] JSON of a model's answer: fences off, then the whole, the outer object, or the outer array; else None."""
    if text is None:
        return None
    body = re.sub(r"^\s*```[a-zA-Z]*\s*|\s*```\s*$", "", text.strip())
    for a, b in ((0, len(body)), (body.find("{"), body.rfind("}") + 1), (body.find("["), body.rfind("]") + 1)):
        if 0 <= a < b:
            try:
                return json.loads(body[a:b])
            except ValueError:
                continue
    return None


def lenient_rows(text: str | None) -> list[dict]:
    """[FN-38] Objects of an array in a model's answer: without think tags, Python constants as JSON, a cut array as far as it goes."""
    if text is None:
        return []
    body = re.sub(r"(?s)<think>.*?</think>", "", text)
    body = re.sub(r"\bTrue\b", "true", re.sub(r"\bFalse\b", "false", re.sub(r"\bNone\b", "null", body)))
    whole = lenient_json(body)
    if isinstance(whole, list):
        return [r for r in whole if isinstance(r, dict)]
    if isinstance(whole, dict) and "[" not in body[: body.find("{")]:
        return [whole]
    out, decoder, at = [], json.JSONDecoder(), body.find("{")
    while at >= 0:
        try:
            row, end = decoder.raw_decode(body, at)
            out.append(row)
            at = body.find("{", end)
        except ValueError:
            break
    return [r for r in out if isinstance(r, dict)]


def alias_answer(text: str | None) -> dict | None:
    """[FN-39] The first object that holds ``is_alias``."""
    return next((r for r in lenient_rows(text) if "is_alias" in r), None)


def primary_type(value, keys: tuple[str, ...] = ("primary_type", "type", "name", "category")) -> str | None:
    """[FN-31] First text of a nested value: text itself, the first that a list gives, or of an object's keys in order."""
    todo = deque([value])
    while todo:
        v = todo.popleft()
        if isinstance(v, str):
            if v.strip():
                return v.strip()
        elif isinstance(v, list):
            todo.extendleft(reversed(v))
        elif isinstance(v, dict):
            folded = {str(k).strip().lower(): x for k, x in v.items()}
            first = [folded[k] for k in keys if k in folded]
            todo.extendleft(reversed(first + [x for k, x in folded.items() if k not in keys]))
    return None


def functional_roles(value, limit: int = 8) -> list[str]:
    """[FN-36] Texts of a list or one text, the first spelling of each, at most ``limit``."""
    texts = [value] if isinstance(value, str) else [v for v in value if isinstance(v, str)] if isinstance(value, list) else []
    kept: dict[str, str] = {}
    for v in texts:
        if v.strip():
            kept.setdefault(v.strip().lower(), v.strip())
    return list(kept.values())[:limit]


def best_ratio(candidate: str, keys: list[str], threshold: float) -> tuple[int, float] | None:
    """[SM-06] Place of the first key of largest SequenceMatcher ratio at or over ``threshold``.

    Length and letter bounds are exact upper bounds of the ratio, so they only save work.
    """
    best: tuple[int, float] | None = None
    matcher = difflib.SequenceMatcher(None, candidate)
    n = len(candidate)
    for place, key in enumerate(keys):
        floor = best[1] if best else threshold
        if n + len(key) == 0 or 2 * min(n, len(key)) / (n + len(key)) < floor:
            continue
        matcher = difflib.SequenceMatcher(None, candidate, key)
        if matcher.quick_ratio() < floor:
            continue
        ratio = matcher.ratio()
        if ratio >= threshold and (best is None or ratio > best[1]):
            best = (place, ratio)
    return best
