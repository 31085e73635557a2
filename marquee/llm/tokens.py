"""Token ids by the `tokenizers` library, each word encoded once per worker.

Byte-level BPE never joins a character with white space that follows it, nor a letter with a punctuation
mark, so a text can be cut before a space or a line break that follows a character other than white space,
and after the letters of a word; the ids of the pieces are the ids of the text. Ids of words are kept in a
dictionary of bounded size, from which those go first that were not met for long. Texts with any other white space are encoded as a whole.
"""

from __future__ import annotations

import functools
import os
from array import array

import numpy as np

KEPT_WORDS = 250_000
MARKS = ",.;:!?$%&*#+-=/|\\^~@_()[]{}<>\""


def _shown_bytes() -> dict[int, int]:
    """Byte-level vocabularies write each byte as a visible character: printable Latin-1 as itself, the rest from U+0100 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(seen)]
    return dict(zip(seen, seen)) | {b: 0x100 + i for i, b in enumerate(rest)}


class Encoder:
    """Little-endian unsigned 32-bit ids of a text, as bytes."""

    def __init__(self, path: str, kept_words: int = KEPT_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kept_words = kept_words
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.model = self.tokenizer.model
        self.shown = _shown_bytes()
        self.line_break = self.whole("\n")
        self.marks: dict[str, bytes] = {}
        probe = "Ab, cd!\nEf ghé. Ij\nkl 12, it's? ßü\nñ"
        self.cuts = self._by_words(probe) == self.whole(probe)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        found = self._by_words(text) if self.cuts else None
        return self.whole(text) if found is None else found

    def _by_words(self, text: str) -> bytes | None:
        """None if the text has white space where it cannot be cut."""
        if "\0" in text:
            return None
        first, *pieces = text.replace("\n", "\0\n").replace(" ", "\0 ").split("\0")
        if len(self.words) > self.kept_words:  # words not met again while as many others were are forgotten
            self.older, self.words = self.words, {}
        words = self.words
        parts = list(map(words.get, pieces))
        at = -1
        try:
            while True:  # until there is no further piece without ids
                at = parts.index(None, at + 1)
                piece = pieces[at]
                ids = words.get(piece) or self.older.get(piece) or self._learned(piece)
                if ids is None:
                    return None
                words[piece] = parts[at] = ids
        except ValueError:
            pass
        start = self._unit(first) if first.isalpha() else self.whole(first) if first else b""
        return start + b"".join(parts)

    def _learned(self, piece: str) -> bytes | None:
        """Ids of a new piece, None if it is not safe to cut off."""
        core = piece[1:]
        if core.isalpha():
            return self._letters(piece)
        base = piece.rstrip(MARKS)
        if base[1:].isalpha():  # marks that follow letters are a unit of their own
            tail = piece[len(base) :]
            marks = self.marks.get(tail)
            if marks is None:
                marks = self.whole(tail)
                if len(self.marks) < 10_000:
                    self.marks[tail] = marks
            return (self.words.get(base) or self._letters(base)) + marks
        if len(piece.split()) != 1 or piece[-1].isspace() or core[:1].isspace():
            return None
        return self.whole(piece)

    def _letters(self, piece: str) -> bytes:
        """A space and letters are one unit of the model; a line break is a unit of its own."""
        if piece[0] == "\n":
            return self.line_break + self._unit(piece[1:])
        return self._unit(piece)

    def _unit(self, piece: str) -> bytes:
        if piece.isascii():
            shown = "\u0120" + piece[1:] if piece[0] == " " else piece  # U+0120 stands for the space
        else:
            shown = piece.encode().decode("latin-1").translate(self.shown)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per Python worker."""
    return Encoder(path)
