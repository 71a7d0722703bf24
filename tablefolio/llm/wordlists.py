"""Words of whole UTF-8 texts, piece by piece, so that a very long text never becomes one list of words."""

from __future__ import annotations

from collections.abc import Iterator

PIECE = 1 << 20
LETTERS = bytes(range(0x61, 0x7B))
CAPITALS = bytes(range(0x41, 0x5B))


def spacing(dropped: bytes) -> bytes:
    """A translation table: ASCII letters to lower case, the bytes `dropped` to spaces."""
    return bytes.maketrans(CAPITALS + dropped, LETTERS + b" " * len(dropped))


def word_lists(text: bytes, table: bytes, piece: int = PIECE) -> Iterator[list[bytes]]:
    """The words of `text` in order, in lists from pieces of about `piece` bytes that end between words."""
    text = text.translate(table)
    begin = 0
    while begin < len(text):
        end = text.find(b" ", begin + piece)
        end = len(text) if end < 0 else end
        yield text[begin:end].split()
        begin = end


WHITE = spacing(b"\t\n\v\f\r")
TERMS = spacing(bytes(c for c in range(0x80) if not chr(c).isalnum()))
