"""Byte-level BPE by backtracking over longest matches.

A vocabulary's tokens, their bytes read as Latin-1 characters, are the words of an
Aho-Corasick automaton, which gives the longest token at every place of a piece in one
pass.  A piece's ids are found from left to right: take the longest token that may stand
behind the one before, and where the rest cannot be finished, go back and take the next
shorter one.  Two tokens may stand side by side if merging their joined bytes by rank
leaves the seam between them; this is remembered per pair.  Each place is given up at most
once, so the work is linear in the piece's length, and the ids are those of merging the
piece's bytes by rank.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from .common import text_batches

NEVER = float("inf")
STAND_IN = "\U000f0000"       # private use: neither letter, digit nor white space


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file (base64 and number per line).

    Tasks read it by its path, so it lies where the tokenizer package lies on every node.
    """
    with open(path, "rb") as lines:
        return {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}


def _beyond(pattern: str) -> list[str]:
    """Characters which ``regex`` puts into a class of the pattern and tiktoken's engine, with
    older Unicode tables, does not."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([i]): i for i in range(256)}
    out: list[str] = []
    for name in (r"\p{L}", r"\p{N}"):
        if name in pattern:
            engine = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=single,
                                       special_tokens={})
            mine = "".join(regex.findall(name, every))
            known = engine.decode_bytes(engine.encode_ordinary(mine)).decode()
            out += sorted(set(mine) - set(known))
    return out


class Splitter:
    """Matches of a splitting pattern, as tiktoken's engine finds them."""

    def __init__(self, pattern: str):
        self.find = regex.compile(pattern)
        self.newer = set(_beyond(pattern))
        self.stand_in = {ord(c): STAND_IN for c in self.newer}

    def slices(self, text: str, size: int) -> Iterator[list[str]]:
        """The pieces, ``size`` at a time."""
        odd = not text.isascii() and not self.newer.isdisjoint(text)
        found = self.find.finditer(text.translate(self.stand_in) if odd else text)
        while part := [text[m.start():m.end()] for m in islice(found, size)]:
            yield part

    def pieces(self, text: str) -> list[str]:
        if not text.isascii() and not self.newer.isdisjoint(text):
            return [text[m.start():m.end()]
                    for m in self.find.finditer(text.translate(self.stand_in))]
        return self.find.findall(text)


class Merges:
    """How each token arises by merging, and which tokens may stand side by side.

    ``parts[id]`` are the two tokens that merge into a token last (None for a single
    byte).  Tokens that merging never makes of their own bytes are in ``unmade``; they are
    only ever the id of a whole piece.
    """

    def __init__(self, ranks: dict[bytes, int], max_pairs: int = 1 << 17):
        self.ranks = ranks
        self.words = {rank: word for word, rank in ranks.items()}
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.unmade: set[int] = set()
        self.may_meet = lru_cache(maxsize=max_pairs)(self._seam_stays)
        for word, rank in sorted(ranks.items(), key=lambda item: item[1]):
            if len(word) == 1:
                self.parts[rank] = None
                continue
            for cut in range(1, len(word)):
                left, right = ranks.get(word[:cut]), ranks.get(word[cut:])
                if left in self.parts and right in self.parts and self._seam_stays(
                        left, right, rank):
                    self.parts[rank] = (left, right)
                    break
            else:
                self.unmade.add(rank)
        self.may_meet.cache_clear()

    def _born(self, token: int) -> int:
        """Rank of the merge that makes a token; bytes are there from the start."""
        return -1 if self.parts[token] is None else token

    def _seam_stays(self, left: int, right: int, until: float = NEVER) -> bool:
        """Whether no merge below rank ``until`` crosses the seam between two tokens.

        Goes back through the merges that made both, latest first.  At each moment one
        token ends at the seam and one begins there, and each lasts up to the merge that
        uses it up.  They would merge first if their joint rank is below both ranks; of
        equal merges the leftmost goes first.
        """
        left_ends = right_ends = until
        while True:
            joint = self.ranks.get(self.words[left] + self.words[right], NEVER)
            if joint < left_ends and (joint < right_ends or joint == right_ends < until):
                return False
            if self._born(left) > self._born(right):
                left_ends, left = left, self.parts[left][1]
            elif self.parts[right] is not None:
                right_ends, right = right, self.parts[right][0]
            else:
                return True


class _Memory(dict):
    """Packed ids by piece; a piece not in it comes from the older generation or is encoded."""

    def __init__(self, encode, older: dict):
        super().__init__()
        self.encode, self.older = encode, older

    def __missing__(self, piece: str) -> bytes:
        value = self.older.get(piece)
        if value is None:
            ids = self.encode(piece.encode())
            value = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= 64:                              # long ones hardly come again
            self[piece] = value
        return value


class BytePairEncoder:
    """Encodes pieces; remembers those used lately (two generations of ``max_pieces``)."""

    def __init__(self, ranks: dict[bytes, int], max_pieces: int = 150_000):
        self.ranks = ranks
        self.merges = Merges(ranks)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for word, rank in ranks.items():
            if rank not in self.merges.unmade:
                self.automaton.add_word(word.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.size = {rank: len(word) for word, rank in ranks.items()}
        self.shorter = {rank: self._next_prefix(word) for word, rank in ranks.items()}
        self.max_pieces = max_pieces
        self.memory = _Memory(self.ids, {})

    def _next_prefix(self, word: bytes) -> int:
        """The longest token that is a proper prefix of a token (-1: none)."""
        for end in range(len(word) - 1, 0, -1):
            rank = self.ranks.get(word[:end], -1)
            if rank >= 0 and rank not in self.merges.unmade:
                return rank
        return -1

    def ids(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        whole = self.ranks.get(piece)
        if whole is not None or not piece:
            return [] if whole is None else [whole]
        size, shorter, may_meet = self.size, self.shorter, self.merges.may_meet
        longest = np.full(len(piece), -1, np.int32) if len(piece) > 4096 else [-1] * len(piece)
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - size[token]] = token        # later ends are longer matches
        dead = bytearray(len(piece) + 1)                  # places from which no rest fits
        out: list[int] = []
        at, token = 0, int(longest[0])
        while at < len(piece):
            while token >= 0 and (dead[at + size[token]]
                                  or (out and not may_meet(out[-1], token))):
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += size[token]
                token = int(longest[at]) if at < len(piece) else -1
            else:                                         # nothing fits here: go back
                dead[at] = 1
                token = out.pop()
                at -= size[token]
        return out

    def packed(self, pieces: list[str]) -> bytes:
        """Ids of pieces in order, as little-endian unsigned 32-bit integers."""
        if len(self.memory) > self.max_pieces:
            self.memory = _Memory(self.ids, dict(self.memory))
        return b"".join(map(self.memory.__getitem__, pieces))


class Decoder:
    """Bytes of ids, gathered from one table of all tokens' bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.words = [b""] * (max(ranks.values()) + 1)
        for word, rank in ranks.items():
            self.words[rank] = word

    def bytes_of(self, packed: bytes) -> bytes:
        return b"".join(map(self.words.__getitem__, np.frombuffer(packed, "<u4").tolist()))


@lru_cache(maxsize=1)
def worker_tools(path: str, pattern: str) -> tuple[Splitter, BytePairEncoder, Decoder]:
    """This Python worker's tables, shared by the tasks that follow one another in it."""
    ranks = read_ranks(path)
    return Splitter(pattern), BytePairEncoder(ranks), Decoder(ranks)


LONG, SLICE = 1 << 20, 1 << 16      # characters from which a text is cut, pieces of a slice


def encode(docs: DataFrame, ranks: str, pattern: str, doc_id: str = "doc_id",
           text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` (little-endian unsigned 32-bit) of whole texts.

    The ids are tiktoken's (``encode_ordinary``) for the rank file ``ranks`` and the
    splitting ``pattern``: each match of the pattern is encoded by itself and what matches
    nothing is left out.  Special tokens' strings are ordinary text.  A null or empty
    text has no ids; null and repeated ids of documents are kept, a row each; an empty
    table gives no rows; other columns are ignored.  A text of any length is read whole: a
    task holds one text and its ids, and of a text of ``LONG`` characters a slice of its pieces.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, encoder, _ = worker_tools(ranks, pattern)
        for keys, texts in text_batches(batches, 1_000_000):
            rows = []
            for one in texts:
                if len(one) < LONG:
                    rows.append(encoder.packed(splitter.pieces(one)))
                else:
                    rows.append(b"".join(map(encoder.packed, splitter.slices(one, SLICE))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array([len(r) // 4 for r in rows], pa.int64()),
                 pa.array(rows, pa.binary())], ["doc_id", "n_tokens", "ids"])

    return docs.select(docs[doc_id].cast("long").alias("doc_id"),
                       docs[text].cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, ranks: str, pattern: str, ids: str = "ids") -> DataFrame:
    """The rows of ``encoded`` with ``n_bytes`` and ``decoded`` (binary) added.

    Ids outside the vocabulary raise an error; null ids decode to null.
    """
    schema = f"{encoded.schema.simpleString()[7:-1]},n_bytes:bigint,decoded:binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = worker_tools(ranks, pattern)[2]
        for batch in batches:
            place = batch.schema.get_field_index(ids)
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                raw = [None if v is None else decoder.bytes_of(v)
                       for v in part.column(place).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([None if r is None else len(r) for r in raw],
                                             pa.int64()), pa.array(raw, pa.binary())],
                    [*batch.schema.names, "n_bytes", "decoded"])

    return encoded.mapInArrow(run, schema)
