"""Byte-level BPE of whole texts with a public tokenizer file, with a cache of units.

The byte-level pre-tokenizer never joins a white-space run to the text before it. So a text may be cut before each run of
white space that follows other characters; what lies between two cuts (a unit: white space, then what follows it) is encoded by the
library once and kept. Units of a text are found by bytes.split(). Texts with white space outside ASCII, or with a string
that the tokenizer treats as a special token, go through the library as a whole. Units above LONGEST bytes (text without blanks) are
encoded but not kept, and what is kept takes MOST_BYTES at most.
"""

from __future__ import annotations

import array
import functools
import os
import re

import numpy as np

#: Bytes of the cache, as Python counts objects, and of a unit that is kept.
MOST_BYTES = 192 << 20
LONGEST = 48
_OVERHEAD = 2 * 33 + 104  # two bytes objects and their place in a dictionary that is half full
_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_UNIT = re.compile(rb"[ \t\n\r\x0b\x0c]*[^ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+")
#: White space outside ASCII begins with these bytes (U+0085, U+00A0, U+1680, U+2000.., U+205F, U+3000); fixed values.
_WIDE = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")
_ODD = (b"  ", b"\n\n", b" \n", b"\n ", b"\t", b"\r", b"\x0b", b"\x0c")


class Encoder:
    """Encodes texts to little-endian ids of `width` bytes."""

    def __init__(self, path: str, special: bool = True):
        """special: strings of special tokens in a text become those tokens; else they are ordinary text."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()] if special else []
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.dtype = np.dtype("<u2" if self.width == 2 else "<u4")
        self.code = "H" if self.width == 2 else "I"  # of array.array, on little-endian machines
        self.units: dict[bytes, bytes] = {b"": b""}
        self.size = 0

    def whole(self, text: bytes) -> bytes:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, self.dtype).tobytes()

    def cut(self, unit: bytes) -> tuple[bytes, bytes]:
        """A unit as what ends in a letter or digit and the ASCII punctuation after it: always two pieces of their own."""
        core = unit.rstrip(_PUNCTUATION)
        if not core or core == unit or not (core[-1:].isalnum() or core[-1] >= 128 and core.decode()[-1].isalpha()):
            return unit, b""
        return core, unit[len(core) :]

    def learn(self, units: list[bytes], found: list[bytes | None]) -> None:
        """Fill the gaps of `found` with the ids of their units."""
        parts = {u: self.cut(u) for u, ids in zip(units, found) if ids is None}
        missing = [p for p in {p for pair in parts.values() for p in pair if p} if p not in self.units]
        encoded = self.tokenizer.encode_batch_fast([p.decode() for p in missing], add_special_tokens=False)
        ids = {p: array.array(self.code, e.ids).tobytes() for p, e in zip(missing, encoded)}
        get = self.units.get
        joined = {u: (ids.get(a) or get(a)) + (b and (ids.get(b) or get(b))) for u, (a, b) in parts.items()}
        self.keep(ids)
        self.keep({u: joined[u] for u, (_, b) in parts.items() if b})
        ids = joined
        for i, x in enumerate(found):
            if x is None:
                found[i] = ids[units[i]]

    def keep(self, units: dict[bytes, bytes]) -> None:
        """Remember units while there is room."""
        for unit, ids in units.items():
            if len(unit) <= LONGEST and self.size < MOST_BYTES and unit not in self.units:
                self.units[unit] = ids
                self.size += len(unit) + len(ids) + _OVERHEAD

    def __call__(self, text: bytes | None) -> bytes:
        if not text:
            return b""
        if any(w in text for w in _WIDE) and re.search(r"[^\S \t\n\r\x0b\x0c\x1c-\x1f]", text.decode()) or any(s in text for s in self.special):
            return self.whole(text)
        if any(w in text for w in _ODD):
            units = _UNIT.findall(text)
        else:
            units = text.replace(b" ", b"\xff ").replace(b"\n", b"\xff\n").split(b"\xff")
        found = list(map(self.units.get, units))
        if None in found:
            self.learn(units, found)
        return b"".join(found)


@functools.cache
def encoder(path: str, special: bool = True) -> Encoder:
    """One encoder for each Python worker, with its cache."""
    return Encoder(path, special)
