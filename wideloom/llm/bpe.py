"""Byte-level BPE ids by the ``tokenizers`` library, with a word cache.

A text is cut before every single blank or line end that follows a solid
character.  The library's pattern never joins characters across such a place,
so each part has the same ids alone as within the text, and the ids of a part
are looked up.  Texts with any other white space, or two blanks in a row, are
encoded whole.  The cache is a worker's own, is emptied when it holds
``CACHE`` parts, and never changes a result.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np

CACHE = 1_000_000

#: white space other than blank and line feed (Unicode ``\s`` and the ASCII separators), and NUL
_ODD = ["  ", " \n", "\n ", "\n\n", "\t", "\r", "\v", "\f", "\0", *map(chr, range(0x1C, 0x20)), "\x85", "\xa0"]
_ODD_WIDE = [" ", *map(chr, range(0x2000, 0x200B)), " ", " ", " ", " ", "　"]
#: marks that form a part of their own after a letter (no apostrophe: it may start a contraction)
_MARKS = ".,;:!?%$&*#|()\"-"


def byte_alphabet() -> list[str]:
    """The printable character that byte-level models use for each byte:
    visible Latin-1 characters stand for themselves, the others follow from 256."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in set(visible) else chr(next(hidden)) for b in range(256)]


class Parts(dict):
    """Ids by part; a part that is lacking is encoded when asked for."""

    def __init__(self, encode: Callable[[str], bytes], most: int = CACHE):
        super().__init__()
        self.encode, self.most = encode, most

    def __missing__(self, part: str) -> bytes:
        ids = self.encode(part)
        if len(self) >= self.most:
            self.clear()
        self[part] = ids
        return ids


class ByteBpe:
    _open: dict[str, "ByteBpe"] = {}

    @classmethod
    def open(cls, path: str) -> "ByteBpe":
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.alphabet = byte_alphabet()
        self.raw = [i.to_bytes(4, "little") for i in range(1 + max(self.tokenizer.get_vocab().values()))]
        self.cache = Parts(self.part)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def part(self, part: str) -> bytes:
        """Ids of a part that the cache lacks."""
        if part.isalpha() or (part[:1] == " " and part[1:].isalpha()):
            letters = "Ġ" + part[1:] if part[0] == " " else part
            if not part.isascii():
                letters = "".join(map(self.alphabet.__getitem__, part.encode()))
        else:
            stem = part.rstrip(_MARKS)
            if stem and stem != part and stem[-1].isalpha():
                return self.cache[stem] + self.cache[part[len(stem):]]
            return self.whole(part)
        return b"".join([self.raw[t.id] for t in self.model.tokenize(letters)])

    def encode(self, text: str | None) -> bytes:
        """Little-endian 32-bit ids; none for a null or empty text."""
        if not text:
            return b""
        if any(x in text for x in _ODD) or not text.isascii() and any(x in text for x in _ODD_WIDE):
            return self.whole(text)
        parts = text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
        if not parts[0]:
            del parts[0]
        return b"".join(map(self.cache.__getitem__, parts))

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        return [self.encode(t) for t in texts]
