"""Regular expressions written once and brought to each engine's syntax.

Rules are data in Python's syntax (see ``rules``). ``java`` spells out the Unicode classes that the
JVM would read as ASCII, so that a rule means the same in a scan as in a Python worker; ``re2`` is
for the SQL that checks results.
"""

from __future__ import annotations

#: White space, spelled out (what ``str.isspace`` accepts, as far as text holds it).
SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD = r"\p{L}\p{N}_"
_CLASSES = {"s": SPACE, "w": WORD, "d": r"\p{Nd}"}


def java(pattern: str, flags: str = "") -> str:
    out, inside, i = [], False, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\" and i + 1 < len(pattern):
            n = pattern[i + 1]
            if n in _CLASSES:
                out.append(_CLASSES[n] if inside else f"[{_CLASSES[n]}]")
            elif n.lower() in _CLASSES and not inside:
                out.append(f"[^{_CLASSES[n.lower()]}]")
            elif n == "Z":
                out.append(r"\z")
            elif n == "U":
                out.append("\\x{" + pattern[i + 2 : i + 10].lstrip("0") + "}")
                i += 8
            else:
                out.append(c + n)
            i += 2
            continue
        if inside:
            if c == "[":
                c = r"\["
            elif c == "]":
                inside = False
        elif c == "[":
            inside = True
            if pattern[i + 1 : i + 2] == "^":
                out.append("[^")
                i += 2
                continue
        out.append(c)
        i += 1
    on = "d" + "".join({"i": "iu", "m": "m", "s": "s"}[f] for f in flags)
    return f"(?{on})" + "".join(out)


def re2(pattern: str, flags: str = "") -> str:
    """The same pattern for RE2, which has no lookaround."""
    import re

    body = re.sub(r"^\(\?[a-z]+\)", "", java(pattern, flags))
    body = re.sub(r"\\u([0-9A-Fa-f]{4})", r"\\x{\1}", body)
    return (f"(?{flags})" if flags else "") + body


def alternatives(pattern: str) -> list[str]:
    """The alternatives of a pattern at its top level."""
    out, now, depth, inside, i = [], "", 0, False, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            now += pattern[i : i + 2]
            i += 2
            continue
        if inside:
            inside = c != "]" or now[-1] in "[^" and now[-2:] in ("[^", "[")
        elif c == "|" and not depth:
            out.append(now)
            now, i = "", i + 1
            continue
        else:
            inside = c == "["
            depth += (c == "(") - (c == ")")
        now += c
        i += 1
    return [*out, now]


def hoisted(pattern: str) -> str:
    """The same matches with the word boundary that alternatives begin with tested once, not once for each."""
    parts = alternatives(pattern)
    bound = [x[2:] for x in parts if x.startswith(r"\b")]
    if len(bound) < 4 or not all(parts):
        return pattern
    return "|".join([rf"\b(?:{'|'.join(bound)})", *(x for x in parts if not x.startswith(r"\b"))])


def _needed(items) -> frozenset[str] | None:
    """Texts of which every match of a parsed sequence holds one, as long and few as possible; None if there is none."""
    import re._constants as sre

    found: list[frozenset[str]] = []
    run = ""
    for op, arg in [*items, (None, None)]:
        if op is sre.LITERAL:
            run += chr(arg)
            continue
        if run:
            found.append(frozenset([run]))
        run = ""
        part = None
        if op is sre.SUBPATTERN:
            part = _needed(arg[3])
        elif op is sre.BRANCH:
            parts = [_needed(x) for x in arg[1]]
            part = None if None in parts else frozenset().union(*parts)
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] >= 1:
            part = _needed(arg[2])
        if part:
            found.append(part)
    return max(found, key=lambda x: (min(map(len, x)) >= LEAST_NEED, min(min(map(len, x)), 6), -len(x)), default=None)


#: Shortest text worth looking for before a pattern is tried, and the most of them.
LEAST_NEED, MOST_NEEDS = 3, 120


def needs(pattern: str, flags: str = "") -> list[str]:
    """Lower-cased texts of which any match holds at least one; none if that can't be told or isn't worth while."""
    import re
    import re._parser as parser

    body = re.sub(r"^\(\?[a-z]+\)", "", pattern)
    got = _needed(parser.parse(body, re.I if "i" in flags else 0)) or frozenset()
    got = {x.lower() for x in got}
    got = {x for x in got if not any(y != x and y in x for y in got)}
    if not got or min(map(len, got)) < LEAST_NEED or len(got) > MOST_NEEDS or not all(x.isascii() for x in got):
        return []
    return sorted(got)


def sql(pattern: str, flags: str = "") -> str:
    """The pattern as an SQL string literal."""
    return "'" + re2(pattern, flags).replace("'", "''") + "'"
