"""Python regular expressions as Java ones, where the two mean the same.

Cleaner patterns are written in Python's dialect. ``to_java`` gives the Java
spelling, or None when there is no exact one; callers then run the Python engine
in Arrow batches instead.
"""

from __future__ import annotations

import re

# d: only \n ends a line; U: Unicode classes; s, m: dot-all and multi-line
JAVA_FLAGS = "smdU"

_CLASSES = {
    "s": r"\s\x1c-\x1f",
    "w": r"\p{L}\p{N}_",
    "d": r"\d",
}
_QUANTIFIER = re.compile(r"\{(\d*)(?:(,)(\d*))?\}")
_PLAIN_ESCAPES = set("nrtfvabB") | {"\n"}
_NAME = re.compile(r"[A-Za-z][A-Za-z0-9]*\Z")


def compile_python(pattern: str, ignore_case: bool = False) -> re.Pattern:
    flags = re.DOTALL | re.MULTILINE | (re.IGNORECASE if ignore_case else 0)
    return re.compile(pattern, flags)


def may_match_empty(pattern: str) -> bool:
    """Whether zero-width matches are possible; the engines count those differently."""
    if re.search(r"\(\?<?[=!]|\\[bB]", pattern):
        return True
    return compile_python(pattern).search("") is not None


def to_java(pattern: str, ignore_case: bool = False) -> str | None:
    compile_python(pattern, ignore_case)
    out, i, in_class, class_start, negated = [], 0, False, 0, False
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\":
            nxt = pattern[i + 1]
            if nxt in _CLASSES:
                out.append(_CLASSES[nxt] if in_class else f"[{_CLASSES[nxt]}]")
            elif nxt.lower() in _CLASSES:
                if in_class and negated:
                    return None  # Java negates before it joins
                out.append(f"[^{_CLASSES[nxt.lower()]}]")
            elif nxt == "Z":
                out.append(r"\z")
            elif nxt == "A":
                out.append(r"\A")
            elif nxt == "v":
                out.append(r"\x0b")
            elif nxt == "b" and in_class:
                out.append(r"\x08")
            elif nxt == "x" and re.match(r"[0-9a-fA-F]{2}", pattern[i + 2 : i + 4]):
                out.append(pattern[i : i + 4])
                i += 2
            elif nxt == "u" and re.match(r"[0-9a-fA-F]{4}", pattern[i + 2 : i + 6]):
                out.append(pattern[i : i + 6])
                i += 4
            elif nxt in _PLAIN_ESCAPES or not nxt.isalnum():
                out.append("\\" + nxt)
            elif nxt in "123456789" and not in_class:
                if pattern[i + 2 : i + 3].isdigit():
                    return None
                out.append("\\" + nxt)
            else:
                return None
            i += 2
            continue
        if in_class:
            if ch == "]" and i > class_start:
                in_class = False
                out.append(ch)
            elif ch in "[&~|]":
                # nested classes and set operators exist only in Java
                out.append("\\" + ch)
            else:
                out.append(ch)
        elif ch == "[":
            in_class = True
            out.append(ch)
            negated = pattern[i + 1 : i + 2] == "^"
            if negated:
                out.append("^")
                i += 1
            class_start = i + 1
        elif ch in "{}":
            counts = _QUANTIFIER.match(pattern, i)
            if counts and counts[0] != "{}":
                out.append("{" + (counts[1] or "0") + (counts[2] or "") + (counts[3] or "") + "}")
                i = counts.end()
                continue
            out.append("\\" + ch)  # a brace that counts nothing is itself
        elif pattern.startswith("(?P<", i):
            name = pattern[i + 4 : pattern.index(">", i)]
            if not _NAME.match(name):
                return None
            out.append("(?<")
            i += 4
            continue
        elif pattern.startswith("(?P=", i):
            name = pattern[i + 4 : pattern.index(")", i)]
            out.append(rf"\k<{name}>")
            i = pattern.index(")", i) + 1
            continue
        elif pattern.startswith("(?", i) and not re.match(r"\(\?(?:[:=!>]|<[=!])", pattern[i : i + 4]):
            return None
        else:
            out.append(ch)
        i += 1
    flags = JAVA_FLAGS + ("iu" if ignore_case else "")
    return f"(?{flags})" + "".join(out)


def template_to_java(template: str, groups: int) -> tuple[str, bool] | None:
    """A replacement template in Java's form and whether it refers to groups."""
    simple = {"n": "\n", "t": "\t", "r": "\r", "f": "\f", "v": "\v", "a": "\a", "\\": "\\\\"}
    out, i, refers = [], 0, False
    while i < len(template):
        ch = template[i]
        if ch == "$":
            out.append("\\$")
        elif ch == "\\":
            rest = template[i + 1 :]
            named = re.match(r"g<(\w+)>", rest)
            number = re.match(r"[1-9](?!\d)", rest)
            if named or number:
                if groups > 9:
                    return None
                key = named.group(1) if named else number.group(0)
                if not key.isdigit() and not _NAME.match(key):
                    return None
                out.append(f"${key}" if key.isdigit() else f"${{{key}}}")
                refers = True
                i += (named or number).end()
            elif rest[:1] in simple:
                out.append(simple[rest[0]])
                i += 1
            else:
                return None
        else:
            out.append(ch)
        i += 1
    return "".join(out), refers


def literal_of(template: str) -> str:
    """The text of a template without group references."""
    return re.sub("", template, "", count=1)
