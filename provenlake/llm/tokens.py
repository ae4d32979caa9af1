"""Byte-level pre-tokens, shared by token counting and packing.

Both walk whole texts in Python helpers with two levels of caching; whatever the
helpers are not sure about (characters outside ``SAFE``) goes to the library.
"""

from __future__ import annotations

import re
from functools import lru_cache

#: Characters that the pattern module and the library are known to classify alike:
#: ASCII white space and print, precomposed Latin letters, common quotes and dashes.
SAFE = "\\t-\\r\\x20-~¡¿«»À-ÖØ-öø-įı-ſ‐-‧"
UNSAFE = re.compile(f"[^{SAFE}]")


@lru_cache(1)
def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte: itself when printable Latin-1, else the next free code from 256."""
    table, free = {}, 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            table[b] = chr(b)
        else:
            table[b], free = chr(free), free + 1
    return table


def stand_in(piece: str) -> str:
    """``piece`` in the byte alphabet."""
    return piece.encode().decode("latin-1").translate(byte_alphabet())


@lru_cache(8)
def tokenizer(path: str):
    """The library's tokenizer, loaded once per worker; one thread, as tasks already fill the cores."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Worker:
    """Bounded memo of one Python worker: when it is full it starts anew."""

    def __init__(self, limit: int) -> None:
        self.limit, self.known = limit, {}

    def put(self, key, value):
        if len(self.known) >= self.limit:
            self.known.clear()
        self.known[key] = value
        return value
