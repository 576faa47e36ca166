"""Byte-level BPE as a lazily determinised finite-state transducer.

The merges of a vocabulary fix, for every prefix of a piece, one last token: the
token that ends there and may follow the last token of the prefix before it
(two tokens may follow each other if merging their joined bytes gives just
these two). The transducer reads bytes. Its state holds, for each place where a
token could still be under way, the trie node reached and the tokens between
the last emitted one and that place. A token is emitted as soon as all places
agree on it, so lookahead is bounded by the longest token. States and moves
are built when first needed and kept, up to a bound; then they start afresh.

Decoding joins token bytes; an incremental UTF-8 automaton, moved by whole
tokens, tells which bytes already form complete characters.
"""

from __future__ import annotations

import base64
import hashlib
import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segstream.llm.common import TOKENIZER_DIR
from segstream.llm.tokens import UNSAFE

#: Fixed value: the pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
START = -1


class Vocabulary:
    """Ranks, their trie and which tokens may follow each other."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.children: list[dict[int, int]] = [{}]
        self.token_at: list[int] = [START]
        self.pairs: dict[tuple[int, int], bool] = {}
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                if byte not in self.children[node]:
                    self.children[node][byte] = len(self.children)
                    self.children.append({})
                    self.token_at.append(START)
                node = self.children[node][byte]
            self.token_at[node] = rank
        # tokens that merging never makes only ever stand for a whole piece
        for node, rank in enumerate(self.token_at):
            if rank != START and self.merged(self.tokens[rank]) != [rank]:
                self.token_at[node] = START

    @classmethod
    def load(cls, file: str) -> Vocabulary:
        with open(os.path.join(TOKENIZER_DIR, file), "rb") as f:
            return cls({base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())})

    def merged(self, piece: bytes) -> list[int]:
        """The definition: join the adjacent pair of lowest rank until none has one."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def may_follow(self, a: int, b: int) -> bool:
        if a == START:
            return True
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > 2_000_000:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merged(self.tokens[a] + self.tokens[b]) == [a, b]
        return known


class Transducer:
    """Reads one piece at a time; ``feed`` emits what is certain, ``end`` the rest."""

    def __init__(self, vocabulary: Vocabulary, max_states: int = 200_000):
        self.vocabulary, self.max_states = vocabulary, max_states
        self.reset()

    def reset(self) -> None:
        self.states: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.moves: list[dict[int, tuple[int, tuple[int, ...]]]] = []
        self.number(((0, (START,)),))

    def number(self, state: tuple) -> int:
        n = self.numbers.get(state)
        if n is None:
            n = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
        return n

    def move(self, state: tuple, byte: int) -> tuple[tuple, tuple[int, ...]]:
        """The next state and the tokens emitted on the way. A state is a tuple
        of (trie node, tokens since and with the last emitted one)."""
        v, live, ended = self.vocabulary, [], None
        for node, path in state:
            node = v.children[node].get(byte)
            if node is None:
                continue
            token = v.token_at[node]
            if ended is None and token != START and v.may_follow(path[-1], token):
                ended = (*path, token)
            if v.children[node]:
                live.append((node, path))
        live.append((0, ended))
        agreed = 0
        shortest = min(len(p) for _, p in live)
        while agreed + 1 < shortest and len({p[agreed + 1] for _, p in live}) == 1:
            agreed += 1
        emitted = ended[1 : agreed + 1]
        if shortest - agreed > 1:  # nothing can follow the last emitted token any more
            return tuple((n, (START, *p[agreed + 1 :])) for n, p in live), emitted
        return tuple((n, p[agreed:]) for n, p in live), emitted

    def encode(self, piece: bytes) -> list[int]:
        whole = self.vocabulary.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.states) > self.max_states:
            self.reset()
        out: list[int] = []
        n, moves = 0, self.moves
        for byte in piece:
            step = moves[n].get(byte)
            if step is None:
                state, emitted = self.move(self.states[n], byte)
                step = moves[n][byte] = (self.number(state), emitted)
            n = step[0]
            if step[1]:
                out += step[1]
        out += self.states[n][-1][1][1:]
        return out


class Utf8Automaton:
    """States: 0 between characters, then what the next byte has to be."""

    #: state -> [(lowest byte, highest byte, next state)]
    MOVES = {
        0: [(0x00, 0x7F, 0), (0xC2, 0xDF, 1), (0xE0, 0xE0, 4), (0xE1, 0xEC, 2), (0xED, 0xED, 5), (0xEE, 0xEF, 2), (0xF0, 0xF0, 6), (0xF1, 0xF3, 3), (0xF4, 0xF4, 7)],
        1: [(0x80, 0xBF, 0)],
        2: [(0x80, 0xBF, 1)],
        3: [(0x80, 0xBF, 2)],
        4: [(0xA0, 0xBF, 1)],
        5: [(0x80, 0x9F, 1)],
        6: [(0x90, 0xBF, 2)],
        7: [(0x80, 0x8F, 2)],
    }
    BROKEN = 8

    @classmethod
    def run(cls, state: int, data: bytes) -> int:
        for byte in data:
            state = next((n for lo, hi, n in cls.MOVES.get(state, ()) if lo <= byte <= hi), cls.BROKEN)
        return state


class StreamingDecoder:
    """Ids in, complete characters out; what is unfinished waits. ``broken``
    tells whether the bytes so far could not be UTF-8."""

    def __init__(self, vocabulary: Vocabulary, complete: np.ndarray, moves: dict[tuple[int, int], int]):
        self.tokens, self.complete, self.moves = vocabulary.tokens, complete, moves
        self.state, self.held, self.broken = 0, b"", False

    def feed(self, ids: np.ndarray) -> bytes:
        last = -1
        for at in np.flatnonzero(~self.complete[ids]).tolist():
            if self.state and at != last + 1:
                self.state, self.broken = 0, True  # a complete token inside a character
            key = (self.state, int(ids[at]))
            if key not in self.moves:
                self.moves[key] = Utf8Automaton.run(self.state, self.tokens[key[1]])
            self.state, last = self.moves[key], at
            if self.state == Utf8Automaton.BROKEN:
                self.state, self.broken = 0, True
        if self.state and last != len(ids) - 1 and len(ids):
            self.state, self.broken = 0, True
        data = self.held + b"".join(map(self.tokens.__getitem__, ids.tolist()))
        cut = len(data)
        if self.state and not self.broken:
            cut -= 1
            while data[cut] < 0xC0:  # back to the first byte of the character
                cut -= 1
        self.held = data[cut:]
        return data[:cut]

    def end(self) -> bytes:
        self.broken |= self.state != 0
        rest, self.held, self.state = self.held, b"", 0
        return rest


class Codec:
    """Encoder and decoder of one vocabulary file, with kept pieces."""

    def __init__(self, file: str, max_pieces: int = 500_000, max_piece: int = 64):
        import regex

        self.vocabulary = Vocabulary.load(file)
        self.transducer = Transducer(self.vocabulary)
        self.split = regex.compile(PATTERN).findall
        self.known: dict[str, bytes] = {}
        self.max_pieces, self.max_piece = max_pieces, max_piece
        self.complete = np.array([Utf8Automaton.run(0, t) == 0 for t in self.vocabulary.tokens])
        self.decoder_moves: dict[tuple[int, int], int] = {}

    def pieces(self, text: str) -> list[str]:
        """Cut at single spaces and line ends between other characters."""
        if text[0].isspace() or text[-1].isspace() or "\0" in text or UNSAFE.search(text):
            return self.split(text)
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")

    def packed(self, piece: str) -> bytes:
        found = self.known.get(piece)
        if found is None:
            parts = self.split(piece)
            if len(parts) == 1:
                found = array("I", self.transducer.encode(piece.encode())).tobytes()
            else:
                found = b"".join(map(self.packed, parts))
            if len(piece) <= self.max_piece and len(self.known) < self.max_pieces:
                self.known[piece] = found
        return found

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.packed, self.pieces(text))) if text else b"", "<u4")

    def decoder(self) -> StreamingDecoder:
        return StreamingDecoder(self.vocabulary, self.complete, self.decoder_moves)

    def decode(self, ids: np.ndarray) -> bytes:
        d = self.decoder()
        return d.feed(ids) + d.end()


@lru_cache(maxsize=2)
def codec(file: str) -> Codec:
    return Codec(file)


def round_trip(docs: DataFrame, file: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    """Token count and digests of the ids and of the bytes decoded from them.

    Defined results: a null or empty text has no tokens; repeated rows are
    encoded each; a null doc_id is kept; an empty table gives an empty result;
    other columns are dropped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(file)
        for batch in batches:
            sizes, of_ids, of_bytes = [], [], []
            for text in batch["text"]:
                ids = c.encode(text.as_py())
                sizes.append(len(ids))
                of_ids.append(hashlib.sha256(ids.tobytes()).hexdigest())
                of_bytes.append(hashlib.sha256(c.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
