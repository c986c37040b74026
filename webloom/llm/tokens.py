"""Token ids of whole texts: the tokenizer runs once per distinct chunk, not once per text.

Both vocabularies used here never merge across the cut points below, so the ids of a text are
the concatenated ids of its chunks. Ids are carried as little-endian unsigned 32-bit bytes.
"""

from __future__ import annotations

import re
import sys
from array import array

from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

# Each chunk costs some 200 bytes; a full table is emptied, which costs time and changes nothing.
CHUNKS_KEPT = 900_000

# A space before anything but white space always begins a token of a byte-level vocabulary;
# \s here covers all that the tokenizer takes for white space, and more.
_CUT = re.compile(r" (?=\S)")
_IRREGULAR = re.compile(r" (?:\s|\Z)")
# A word with plain punctuation after it, and perhaps a new line and one more word: the
# tokenizers part these before they merge, so each part is looked up on its own.
_WORD = re.compile(r"([^\W\d_]+)([.,;:!?%&$#*]+)(?:\n([^\W\d_]+))?")

# Letters below are composed already, and one by one in lower case, as the vocabularies want them.
_NOT_PLAIN, _DOTTED = "\u0250", "\u0130"


def as_bytes(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class _Chunks(dict):
    """Chunk -> id bytes, filled on first use."""

    def __init__(self, owner: TextEncoder, before: str):
        super().__init__()
        self.owner, self.before = owner, before

    def __missing__(self, chunk: str) -> bytes:
        # the lower case of a dotted I ends in a mark, which goes with the punctuation after it
        parts = None if chunk.isalpha() or _DOTTED in chunk else _WORD.fullmatch(chunk)
        if parts and parts[1].isalpha() and (parts[3] or "a").isalpha():
            plain = self.owner.first
            out = self[parts[1]] + plain[parts[2]]
            if parts[3]:
                out += plain["\n"] + plain[parts[3]]
        else:
            out = as_bytes(self.owner.ids(self.before, chunk))
        if len(self) >= CHUNKS_KEPT:
            self.clear()
        self[chunk] = out
        return out


class TextEncoder:
    """Encodes texts with a tokenizers file. ``spaced`` vocabularies keep the space before a word."""

    def __init__(self, path: str, spaced: bool):
        tokenizer = Tokenizer.from_file(path)
        self.spaced, self.tokenizer = spaced, tokenizer
        self.model, self.normalizer = tokenizer.model, tokenizer.normalizer
        # how byte-level pieces write each byte, read off ASCII, the letters of two bytes and one
        # letter for each first byte of longer ones (U+023A has a lower case of three bytes)
        letters = ByteLevel(add_prefix_space=False, use_regex=False)
        self.written = {}
        longer = [0x800, *range(0x1000, 0xD000, 0x1000), 0xD000, 0xE000, 0xF000]
        for c in map(chr, [*range(0x800), *longer, *range(0x10000, 0x110000, 0x10000)]):
            self.written.update(zip(c.encode(), letters.pre_tokenize_str(c)[0][0]))
        self.space = self.written[0x20]
        self.first = _Chunks(self, "")
        self.rest = _Chunks(self, " ") if spaced else self.first

    def ids(self, before: str, chunk: str) -> list[int]:
        """A run of Latin letters is one piece to the vocabulary's model; all else takes the whole
        tokenizer."""
        if chunk.isalpha() and max(chunk) < _NOT_PLAIN and _DOTTED not in chunk:
            word = chunk.lower() if self.normalizer else chunk
            if not word.isascii():
                word = "".join(map(self.written.__getitem__, word.encode()))
            if before:
                word = self.space + word
            return [t.id for t in self.model.tokenize(word)]
        return self.tokenizer.encode(before + chunk, add_special_tokens=False).ids

    def encode(self, text: str | None) -> bytes:
        """Null counts as empty; an empty text has no ids."""
        if not text:
            return b""
        if self.spaced and _IRREGULAR.search(text):
            head, *rest = _CUT.split(text)
        else:
            head, *rest = text.split(" ")
        return self.first[head] + b"".join(map(self.rest.__getitem__, rest))


_ENCODERS: dict[tuple[str, bool], TextEncoder] = {}


def encoder(path: str, spaced: bool) -> TextEncoder:
    """The encoder of this Python worker, kept from task to task."""
    if (path, spaced) not in _ENCODERS:
        _ENCODERS[path, spaced] = TextEncoder(path, spaced)
    return _ENCODERS[path, spaced]
