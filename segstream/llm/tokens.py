"""Token ids of whole texts by a public tokenizer file, one Arrow batch at a time.

A text is cut at single spaces and line ends between two other characters. No
pre-token of the supported files crosses such a place, so a text's ids are its
pieces' ids in a row; each distinct piece is encoded once and kept as packed
bytes. Texts with a run of white space, or white space at an end, are encoded
whole, unless the tokenizer drops white space anyway.
"""

from __future__ import annotations

import os
import re
import string
import struct
from functools import lru_cache

import numpy as np

from segstream.llm.common import TOKENIZER_DIR

#: A space or line end beside other white space.
UNSAFE = re.compile(r"[ \n](?:(?=\s)|(?<=\s[ \n]))")
#: Separators that are white space to Python's split() but not to tokenizers.
ODD_SPACE = re.compile("[\x1c-\x1f]")
#: The last letter of Latin Extended-B. Up to it, letters are their own NFC form.
LAST_LATIN = "\u024f"


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


BYTE_LETTERS = byte_letters()


#: ASCII marks that never join the letters before them.
MARKS = string.punctuation.replace("'", "")


class Known(dict):
    """Pieces kept from earlier batches; ``new`` has those of the running batch."""

    new: dict[str, bytes]

    def __missing__(self, piece: str) -> bytes:
        return self.new[piece]


class Encoder:
    """``packed(texts)`` gives each text's ids as little-endian bytes of ``dtype``."""

    def __init__(self, file: str, max_pieces: int = 500_000, max_piece: int = 64):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(os.path.join(TOKENIZER_DIR, file))
        self.tokenizer.encode_special_tokens = True
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.keep_space = self.tokenizer.normalizer is None
        self.known = Known()
        self.max_pieces, self.max_piece = max_pieces, max_piece
        self.marks = {"": b""}

    def encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for i in range(0, len(texts), 4096):
            found = self.tokenizer.encode_batch_fast(texts[i : i + 4096], add_special_tokens=False)
            out += [np.array(x.ids, self.dtype).tobytes() for x in found]
        return out

    def pieces(self, text: str) -> list[str]:
        if not self.keep_space:
            return [text] if ODD_SPACE.search(text) else text.split()
        if text[0].isspace() or text[-1].isspace() or "\0" in text or UNSAFE.search(text):
            return [text]
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")

    def tail(self, marks: str) -> bytes:
        """Ids of a run of marks that follows letters."""
        if marks not in self.marks:
            ids = self.encode([marks])[0]
            if len(marks) > 8:
                return ids
            self.marks[marks] = ids
        return self.marks[marks]

    def word(self, piece: str) -> str | None:
        """The piece as the model reads it, if it is one run of Latin letters
        (after at most one space where spaces count); else None."""
        letters = piece.removeprefix(" ") if self.keep_space else piece
        if not letters.isalpha():
            return None
        if piece.isascii():  # each letter stands for itself
            if not self.keep_space:
                return piece.lower()
            return letters if len(letters) == len(piece) else BYTE_LETTERS[32] + letters
        if max(letters) > LAST_LATIN:
            return None
        if not self.keep_space:
            piece = piece.lower()
            if not piece.isalpha():
                return None
        return piece.encode().decode("latin-1").translate(BYTE_LETTERS)

    def learn(self, pieces: set[str]) -> None:
        """Encode the unknown pieces. Letters go straight to the BPE model, marks
        after them are looked up; the rest goes through the whole tokenizer."""
        new, other, tokenize, code = {}, [], self.tokenizer.model.tokenize, "H" if self.dtype.itemsize == 2 else "I"
        for p in pieces:
            core = p.rstrip(MARKS)
            word = self.word(core)
            if word is None:
                other.append(p)
            else:
                ids = [t.id for t in tokenize(word)]
                new[p] = struct.pack(f"<{len(ids)}{code}", *ids)
                if len(core) < len(p):
                    new[p] += self.tail(p[len(core) :])
        new.update(zip(other, self.encode(other)))
        self.known.new = new

    def keep(self) -> None:
        """Keep short pieces while there is room; early ones are the frequent ones."""
        room = self.max_pieces - len(self.known)
        if room > 0:
            self.known.update([x for x in self.known.new.items() if len(x[0]) <= self.max_piece][:room])
        self.known.new = {}

    def packed(self, texts: list[str | None]) -> list[bytes]:
        return self.joined([self.pieces(t) if t else [] for t in texts])

    def once(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces that won't come again; none is kept."""
        self.learn(set(pieces).difference(self.known))
        out = list(map(self.known.__getitem__, pieces))
        self.known.new = {}
        return out

    def joined(self, cut: list[list[str]]) -> list[bytes]:
        """The ids of each list of pieces."""
        self.learn(set().union(*cut).difference(self.known))
        out = [b"".join(map(self.known.__getitem__, c)) for c in cut]
        self.keep()
        return out


@lru_cache(maxsize=4)
def encoder(file: str) -> Encoder:
    return Encoder(file)
