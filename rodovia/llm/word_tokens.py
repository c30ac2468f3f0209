"""Token ids of whole texts by a word-level BPE of the tokenizers library, with a cache of word pieces."""

from __future__ import annotations

import re
import sys
from array import array

#: Bound of each of the cache's two generations, in entries of some 200 bytes. A full young generation becomes
#: the old one, from which words that occur again are taken over. Chunks of more than CACHED_BYTES are not kept.
CACHE_ENTRIES = 300_000
CACHED_BYTES = 64

#: Chunks of these characters need no normalisation but lower case, so their pieces can be looked up one by one.
#: The split pattern is the one of the vocabulary file, written out for these characters.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+\\Z")
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
#: A full stop or comma next to another mark belongs to one piece with it.
_JOINED = re.compile(rb"[.,][!-/:-@\[-`{-~]|[!-+\-/:-@\[-`{-~][.,]")


class Unusual(Exception):
    """A chunk that only the library can normalise."""


def default_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordTokens:
    """``encode(text)`` gives the ids as little-endian unsigned 32-bit numbers.

    The ids are those of ``Tokenizer.encode(text, add_special_tokens=False)``. Pieces met before come from a
    cache of bounded size; a text with any unusual character goes through the library as a whole.
    """

    def __init__(self, file: str | None = None):
        import os

        assert sys.byteorder == "little" and array("I").itemsize == 4
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file or default_file())
        model, symbols = self.tokenizer.model, byte_symbols()

        def ids_of(piece: str) -> bytes:
            shown = piece if piece.isascii() else "".join([symbols[b] for b in piece.encode()])
            return array("I", [t.id for t in model.tokenize(shown)]).tobytes()

        class Chunks(dict):
            """Ids of runs without white space."""

            old: dict[bytes, bytes] = {}

            def __missing__(self, chunk: bytes) -> bytes:
                ids = self.old.get(chunk)
                if ids is None:
                    word = chunk.decode()
                    if not _PLAIN.match(word):
                        raise Unusual
                    pieces = [word] if word.isalpha() and word.isascii() else _PIECE.findall(word.lower())
                    ids = ids_of(pieces[0]) if len(pieces) == 1 else b"".join([self[p.encode()] for p in pieces])
                    if len(chunk) > CACHED_BYTES:
                        return ids
                if len(self) >= CACHE_ENTRIES:
                    self.old = dict(self)
                    self.clear()
                self[chunk] = ids
                return ids

        self.chunks = Chunks()

    def encode(self, text: str) -> bytes:
        raw = text.encode()
        if b"<|" not in raw:
            raw = raw.lower()
            if not _JOINED.search(raw):  # then these marks are pieces of their own, and more chunks are alike
                raw = raw.replace(b".", b" . ").replace(b",", b" , ")
            try:
                return b"".join(map(self.chunks.__getitem__, raw.split()))
            except Unusual:
                pass
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
