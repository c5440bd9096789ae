"""Token ids of whole texts by a given tokenizer file, with a memory of words already seen.

The ids are the library's. Texts in Latin script are cut at single spaces, where neither pattern of the two supported
kinds of pre-tokenizer can span the cut. A worker remembers the ids of up to CACHE pieces, first come first kept, and
starts afresh after RENEW pieces that it could not keep, so that its memory is bounded. Inside a piece, runs of letters go straight to the model of the tokenizer. Every text outside
the safe range, or with white space next to a space, is encoded whole by the library.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Callable, Iterable

import regex
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

CACHE, RENEW = 500_000, 4_000_000
# Characters whose classes, lower case and normal forms are the same for every Unicode version, and no separators that
# the libraries class differently.
_UNSAFE = regex.compile(r"[^\x00-\x1b\x20-\x84\x86-įı-ſ]")
_CONTROLS = "\x1c\x1d\x1e\x1f\x85"
_SPACED = regex.compile(r"\s \s|  \Z")
_AFTER_SPACE = [" " + c for c in " \n\t\r\x0b\x0c\xa0"]
# The split patterns of the two supported tokenizer kinds, with case folding done before the first.
_LETTERS_END = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_SPACE_LEADS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def _byte_letters() -> dict[int, str]:
    """How the byte level writes every safe character, asked from the library."""
    level = ByteLevel(add_prefix_space=False, use_regex=False)
    return {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0x180)}


def separable(text: str) -> bool:
    """Whether the text may be cut at its single spaces."""
    try:
        text.encode("latin-1")
        safe = not any(c in text for c in _CONTROLS)
    except UnicodeEncodeError:
        safe = not _UNSAFE.search(text)
    return safe and not (any(c in text for c in _AFTER_SPACE) and _SPACED.search(text))


class Encoder:
    """Token ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        # Special strings inside a text are ordinary text.
        self.tokenizer.encode_special_tokens = True
        self.folds = self.tokenizer.normalizer is not None
        self.pattern = (_LETTERS_END if self.folds else _SPACE_LEADS).findall
        self.letters = _byte_letters()
        self.split = self.tokenizer.model.tokenize
        self.pieces: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}
        self.unkept = 0

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def run(self, part: str) -> bytes:
        found = self.runs.get(part)
        if found is None:
            known = part if part.isascii() and part.isalpha() else part.translate(self.letters)
            found = array("I", [t.id for t in self.split(known)]).tobytes()
            if len(self.runs) < CACHE:
                self.runs[part] = found
        return found

    def piece(self, text: str) -> bytes:
        """Ids of a piece that is not remembered yet."""
        found = b"".join([self.run(r) for r in self.pattern(text)])
        if len(self.pieces) < CACHE:
            self.pieces[text] = found
        else:
            self.unkept += 1
            if self.unkept >= RENEW:
                self.pieces, self.runs, self.unkept = {}, {}, 0
        return found

    def encode(self, text: str) -> bytes:
        if "\0" in text or not separable(text):
            return self.whole(text)
        parts = text.lower().split(" ") if self.folds else text.replace(" ", "\0 ").split("\0")
        seen = self.pieces.get
        return b"".join([seen(p) or self.piece(p) for p in parts])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode_all(path: str, texts: Iterable[str | None], end: int) -> list[bytes]:
    """Ids of each text with the end id after them; a null text has the end id alone."""
    encode: Callable[[str], bytes] = encoder(path).encode
    last = int(end).to_bytes(4, "little")
    return [(encode(t) if t else b"") + last for t in texts]
