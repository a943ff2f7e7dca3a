"""Token ids of whole texts, equal to the ``tokenizers`` library's, at corpus speed.

Both vocabularies cut a text before any merge is looked up, and never inside a
run of non-space characters across a plain space.  So a text is the sequence
of its space-separated chunks, and each distinct chunk is encoded once per
worker by the library's own model and remembered (a bounded table: the size
only decides how often a chunk is encoded again).  A text in which blanks are
not single spaces or single line feeds between words, or with the string of an
added token (``<|endoftext|>``), is given to the library as it is.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from functools import lru_cache
from itertools import filterfalse, islice

import regex

#: Entries of a worker's tables of pieces and of chunks; a full one is emptied.
PIECE_ENTRIES, CHUNK_ENTRIES = 700_000, 200_000

# The pre-tokenizer patterns stated in the two vocabulary files'
# descriptions (byte level: leading space belongs to the token; word level:
# blanks are dropped, digits are single).
BYTE_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


SEPARATORS = re.compile("[\x1c-\x1f]").search


def _byte_alphabet() -> dict[int, str]:
    """Byte-level vocabularies print bytes as characters: printable Latin-1
    bytes as themselves, the others as U+0100 and up in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in set(plain))
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """``encode(text)`` -> ids as little-endian uint32 bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        added = self.tok.get_added_tokens_decoder().values()
        self.added = [t.content for t in added]
        # those are found in the normal form of a text, so any text may hold them
        self.hidden = any(t.normalized for t in added) and self.tok.normalizer is not None
        self.byte_level = self.tok.normalizer is None
        self.alphabet = _byte_alphabet()
        self.cut = regex.compile(BYTE_PIECES if self.byte_level else WORD_PIECES).findall
        self.pieces: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}  # chunks without a space before them
        self.spaced: dict[str, bytes] = {} if self.byte_level else self.bare
        self.model = self.tok.model

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            mapped = piece.encode().decode("latin-1").translate(self.alphabet)
            ids = array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()
            if len(self.pieces) >= PIECE_ENTRIES:
                self.pieces.clear()
            self.pieces[piece] = ids
        return ids

    def _learn(self, chunks, space: str) -> dict[str, bytes]:
        """The ids of each chunk, in a table of their own."""
        piece, learned = self._piece, {}
        for chunk in chunks:
            form = chunk
            if not self.byte_level and not (chunk.isascii() and chunk.islower()):
                if max(chunk) >= "\u0250":  # normal forms beyond Latin: left to the library
                    learned[chunk] = self._whole(chunk)
                    continue
                form = "".join(map(str.lower, unicodedata.normalize("NFC", chunk)))
            if form.isalpha():
                learned[chunk] = piece(space + form)
            elif form[-1] in ".,;:!?" and form[:-1].isalpha():
                learned[chunk] = piece(space + form[:-1]) + piece(form[-1])
            else:
                learned[chunk] = b"".join(map(piece, self.cut(space + form)))
        return learned

    def _ids(self, known: dict, chunks: list[str], space: str) -> bytes:
        new = set(filterfalse(known.__contains__, chunks))
        if not new:
            return b"".join(map(known.__getitem__, chunks))
        learned = self._learn(new, space)
        if len(known) + len(learned) <= CHUNK_ENTRIES:
            known.update(learned)
            return b"".join(map(known.__getitem__, chunks))
        # the table is emptied only when the ids of this text are out of it
        ids = b"".join([learned[c] if c in learned else known[c] for c in chunks])
        known.clear()
        known.update(islice(learned.items(), CHUNK_ENTRIES))
        return ids

    def _whole(self, text: str) -> bytes:
        return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self.hidden or any(a in text for a in self.added):
            return self._whole(text)
        if self.byte_level:
            return self._byte_text(text)
        if SEPARATORS(text):  # blank to Python, not to the vocabulary's pattern
            return self._whole(text)
        return self._ids(self.bare, text.split(), "")

    def _byte_text(self, text: str) -> bytes:
        lines = text.split("\n")
        if not "".join(lines).isprintable() or "  " in text or any(
                not line or line[0] == " " or line[-1] == " " for line in lines):
            return self._whole(text)
        newline = self._piece("\n")
        out = []
        for line in lines:
            words = line.split(" ")
            out.append(self._ids(self.bare, words[:1], "") + self._ids(self.spaced, words[1:], " "))
        return newline.join(out)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary file."""
    return Encoder(path)
