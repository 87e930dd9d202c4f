"""Regular expressions with gaps, rewritten so that the matcher needs one pass.

`A.*B.*C` makes a backtracking matcher look for B and C from each A again, which is quadratic in a long text. Whether it
matches at all is told by the first end of an A, the first end of a B after that, and so on. linear() writes that as
atomic groups from the start of the text, for each alternative of a pattern whose parts before gaps are finite sets of
strings; other alternatives stay as they are. Which part of a text matches is not kept, only whether one does.
"""

from __future__ import annotations

import re

MOST_STRINGS = 256
_QUANTIFIERS = "?*+{"


def _close(p: str, at: int) -> int:
    """The place after the bracket or group that opens at a place."""
    if p[at] == "[":
        end = at + 1 + (p[at + 1] == "^")
        end += p[end] == "]"
        while p[end] != "]":
            end += 2 if p[end] == "\\" else 1
        return end + 1
    depth, end = 0, at
    while True:
        c = p[end]
        if c == "\\":
            end += 1
        elif c == "[":
            end = _close(p, end) - 1
        depth += (c == "(") - (c == ")")
        end += 1
        if not depth:
            return end


def _split(p: str, at: str) -> list[str]:
    """p split at a mark outside of groups, classes and escapes."""
    out, start, i = [], 0, 0
    while i < len(p):
        if p.startswith(at, i) and not (at == ".*" and p[i + 2 : i + 3] in ("?", "+")):
            out.append(p[start:i])
            i = start = i + len(at)
        elif p[i] in "([":
            i = _close(p, i)
        else:
            i += 2 if p[i] == "\\" else 1
    return [*out, p[start:]]


def _inner(p: str) -> str | None:
    """What a group holds, if p is one plain group."""
    if not p.startswith("(") or _close(p, 0) != len(p) or p.startswith("(?") and not p.startswith("(?:"):
        return None
    return p[3:-1] if p.startswith("(?:") else p[1:-1]


def strings(p: str) -> list[str] | None:
    """All strings that a pattern matches, if it is literals, groups of alternatives, short classes and what may be left out."""
    out: set[str] = set()
    for alternative in _split(p, "|"):
        own, i = [""], 0
        while i < len(alternative):
            c = alternative[i]
            if c in "([":
                end = _close(alternative, i)
                part = alternative[i:end]
                if c == "[":
                    body = part[1:-1]
                    choice = None if re.search(r"[\^\\\-\[&]", body) else list(body)
                else:
                    choice = strings(_inner(part)) if _inner(part) is not None else None
                i = end
            elif c == "\\":
                choice, i = ([alternative[i + 1]] if not alternative[i + 1].isalnum() else None), i + 2
            else:
                choice, i = (None if c in ".^$*+?{})" else [c]), i + 1
            if choice is None:
                return None
            if alternative[i : i + 1] == "?" and alternative[i + 1 : i + 2] not in ("?", "+"):
                choice, i = [*choice, ""], i + 1
            elif alternative[i : i + 1] and alternative[i] in _QUANTIFIERS:
                return None
            own = [a + b for a in own for b in choice]
            if len(own) > MOST_STRINGS:
                return None
        out.update(own)
    return sorted(out) if len(out) <= MOST_STRINGS else None


def _spread(alternative: str) -> list[str]:
    """An alternative as several, none of which has a gap within a group."""
    parts = _split(alternative, ".*")
    for i, part in enumerate(parts):
        at = 0
        while at < len(part):
            if part[at] == "(":
                end = _close(part, at)
                inside = _inner(part[at:end])
                if inside is not None and part[end : end + 1] not in tuple(_QUANTIFIERS) and any(len(_split(x, ".*")) > 1 or len(_spread(x)) > 1 for x in _split(inside, "|")):
                    whole = lambda x: ".*".join([*parts[:i], part[:at] + x + part[end:], *parts[i + 1 :]])  # noqa: B023, E731
                    return [y for x in _split(inside, "|") for y in _spread(whole(x))]
                at = end
            else:
                at = _close(part, at) if part[at] == "[" else at + (2 if part[at] == "\\" else 1)
    return [alternative]


def _without_longer(found: list[str]) -> list[str]:
    """Strings that aren't found, or end first, wherever they stand: of two, one that has the other before its end tells nothing more."""
    low = {s: s.lower() for s in found}
    return [s for s in found if not any(low[t] in low[s][:-1] for t in found if t != s)]


def _in_order(alternative: str) -> str:
    parts = _split(alternative, ".*")
    if len(parts) == 1:
        return alternative
    known = [strings(p) for p in parts[:-1]]
    if any(k is None for k in known):
        return alternative
    quote = lambda s: re.sub(r"([^\w\s])", r"\\\1", s)
    steps = "".join(f"(?>.*?(?:{'|'.join(map(quote, _without_longer(k)))}))" for k in known if "" not in k)
    return rf"\A{steps}.*?(?:{parts[-1]})"


def linear(pattern: str) -> str:
    """A pattern that finds a match in the same texts. Only patterns in which the dot stands for newlines too are changed."""
    flags = m[0] if (m := re.match(r"\(\?[a-zA-Z]+\)", pattern)) else ""
    body = pattern[len(flags) :]
    if "s" not in flags or ".*" not in body:
        return pattern
    while (inside := _inner(body)) is not None:
        body = inside
    done = [_in_order(y) for x in _split(body, "|") for y in _spread(x)]
    return flags + "|".join(done)
