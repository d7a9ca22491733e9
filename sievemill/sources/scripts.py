"""Reading calls out of the scripts of a page, token by token."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple


class Token(NamedTuple):
    """A piece of a script: a quoted ``text`` (without quotes and escapes), a ``word``, or one other ``sign``."""

    kind: str
    value: str


def tokens(script: str, at: int = 0) -> Iterator[Token]:
    """The tokens of a script from a place on; blanks are left out. A text without its closing quote reaches to the end."""
    while at < len(script):
        c = script[at]
        if c in "'\"":
            out, at = [], at + 1
            while at < len(script) and script[at] != c:
                at += script[at] == "\\"
                out.append(script[at : at + 1])
                at += 1
            yield Token("text", "".join(out))
            at += 1
        elif c.isalnum() or c in "_$":
            start = at
            while at < len(script) and (script[at].isalnum() or script[at] in "_$"):
                at += 1
            yield Token("word", script[start:at])
        else:
            if not c.isspace():
                yield Token("sign", c)
            at += 1


def calls(script: str, name: str) -> Iterator[list[Token]]:
    """The tokens between the brackets of each call of ``name`` that isn't within quotes of the script."""
    at = script.find(f"{name}(")
    while at >= 0:
        depth, inside = 0, []
        for t in tokens(script, at + len(name)):
            if t == Token("sign", "("):
                depth += 1
                if depth == 1:
                    continue
            elif t == Token("sign", ")"):
                depth -= 1
                if depth == 0:
                    break
            inside.append(t)
        yield inside
        at = script.find(f"{name}(", at + 1)


def texts(call: list[Token]) -> list[str]:
    """The quoted texts of a call in their order."""
    return [t.value for t in call if t.kind == "text"]


def text_after(call: list[Token], key: str) -> str | None:
    """The first quoted text after a key, be the key quoted or not."""
    place = next((i for i, t in enumerate(call) if t.kind != "sign" and t.value == key), None)
    return None if place is None else next(iter(texts(call[place + 1 :])), None)
