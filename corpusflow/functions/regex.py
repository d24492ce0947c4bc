"""Python ``re`` dialect -> Java regex dialect used by Spark's regex functions.

Patterns in curation configs are written for Python.  Almost all of them are
valid Java regexes once Unicode character classes are switched on; the rest
of the differences are handled here so that an operator never silently
behaves differently:

* ``(?U)`` is prefixed so ``\\w \\d \\s \\b`` are Unicode-aware as in Python 3.
* ``(?P<name>`` becomes ``(?<name>`` and ``(?P=name)`` becomes ``\\k<name>``.
* a ``{`` that does not open a quantifier is escaped (Java rejects it).
* replacement strings: ``\\1`` / ``\\g<1>`` / ``\\g<name>`` become ``$1`` /
  ``${name}``; a literal ``$`` is escaped; Python escapes ``\\n`` and ``\\t``
  in the replacement are resolved.
"""

from __future__ import annotations

import re

_QUANT = re.compile(r"\{\d*(,\d*)?\}")


def to_java_pattern(pattern: str, unicode: bool = True) -> str:
    out = []
    i = 0
    n = len(pattern)
    in_class = False
    while i < n:
        c = pattern[i]
        if c == "\\" and i + 1 < n:
            out.append(pattern[i:i + 2])
            i += 2
            continue
        if in_class:
            if c == "]":
                in_class = False
            out.append(c)
            i += 1
            continue
        if c == "[":
            in_class = True
            out.append(c)
            i += 1
            # a ']' right after '[' or '[^' is literal in Python
            if i < n and pattern[i] == "^":
                out.append("^")
                i += 1
            if i < n and pattern[i] == "]":
                out.append("\\]")
                i += 1
            continue
        if pattern.startswith("(?P<", i):
            out.append("(?<")
            i += 4
            continue
        if pattern.startswith("(?P=", i):
            j = pattern.index(")", i)
            out.append("\\k<" + pattern[i + 4:j] + ">")
            i = j + 1
            continue
        if c == "{":
            m = _QUANT.match(pattern, i)
            if m and m.group(0) not in ("{}", "{,}") and i > 0:
                out.append(m.group(0))
                i = m.end()
                continue
            out.append("\\{")
            i += 1
            continue
        if c == "}":
            out.append("\\}")
            i += 1
            continue
        out.append(c)
        i += 1
    java = "".join(out)
    return ("(?U)" + java) if unicode else java


_SIMPLE_ESC = {"n": "\n", "t": "\t", "r": "\r", "f": "\f", "v": "\v", "a": "\a", "b": "\b"}


def to_java_replacement(repl: str) -> str:
    out = []
    i = 0
    n = len(repl)
    while i < n:
        c = repl[i]
        if c == "\\" and i + 1 < n:
            d = repl[i + 1]
            if d.isdigit():
                j = i + 1
                while j < n and repl[j].isdigit() and j - i <= 2:
                    j += 1
                out.append("$" + repl[i + 1:j])
                i = j
                continue
            if d == "g" and i + 2 < n and repl[i + 2] == "<":
                j = repl.index(">", i)
                name = repl[i + 3:j]
                out.append("$" + name if name.isdigit() else "${" + name + "}")
                i = j + 1
                continue
            if d in _SIMPLE_ESC:
                out.append(_SIMPLE_ESC[d])
                i += 2
                continue
            if d == "\\":
                out.append("\\\\")
                i += 2
                continue
            # unknown escapes are kept literally by Python for ASCII letters
            out.append("\\\\" + d if d.isalpha() else d)
            i += 2
            continue
        if c == "$":
            out.append("\\$")
            i += 1
            continue
        out.append(c)
        i += 1
    return "".join(out)


def shift_group_refs(java_repl: str, by: int) -> str:
    """Shift ``$n`` references by ``by`` (used when a pattern is wrapped
    in an extra leading group)."""
    return re.sub(r"(?<!\\)\$(\d+)", lambda m: "$%d" % (int(m.group(1)) + by), java_repl)
