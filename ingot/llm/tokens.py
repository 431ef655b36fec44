"""Whole-text tokenisation with the ``tokenizers`` library, one call per distinct piece.

Both vocabularies never merge across a space, so a text is cut at its spaces,
each distinct piece goes through the library once per worker, and the ids of a
text are gathered from that memory.  Of longer white space only the last space belongs to
the word behind it, in byte-level pre-tokenisation, so only there is a text cut.  A text
that holds the string of an added token, which the library finds before it cuts a text, is
one piece.
"""

from __future__ import annotations

import os
import re
from codecs import charmap_decode
from functools import lru_cache
from itertools import repeat

import numpy as np

_LOOKAHEAD = re.compile(r" (?:\s|\Z)")
_LAST_SPACE = re.compile(r" (?=\S)")     # of white space before a word, which takes it along
MARK = "\x01"
SPACE = "\u0120"      # how byte-level vocabularies write the space byte
END = "</w>"          # how word-end vocabularies write a word's end
_SEPARATORS = re.compile("[\x1c-\x1f]")
# Pieces of these Latin-1 characters only are cut into the parts that pre-tokenisation cuts
# them into.  Normalisation changes them by lower case at most, character by character.
_PLAIN = re.compile("[!-~\xa1-\xac\xae-\xff]+")
CUT = "\ud800"         # in no text, since it is half a character
_LETTER, _NUMBER = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾"
# How byte-level vocabularies write a byte: as the Latin-1 character where that is printable,
# and the others as the characters from 256 on; but white space between words stays, and
# LEAD stands for a space that belongs to a word.
LEAD = "\x02"
_OTHERS = [b for b in range(256) if not _PLAIN.fullmatch(chr(b))]
_BYTES = "".join(" " if b == 0x20 else SPACE if chr(b) == LEAD else chr(256 + _OTHERS.index(b))
                 if b in _OTHERS else chr(b) for b in range(256))
_CONTRACTED = "'s|'t|'re|'ve|'m|'ll|'d"
_LEAD_PARTS = re.compile(f"{CUT}|{_CONTRACTED}| ?[{_LETTER}]+| ?[{_NUMBER}]+"
                         f"| ?[^\\s{CUT}{_LETTER}{_NUMBER}]+")
_DROP_PARTS = re.compile(f"{CUT}|{_CONTRACTED}|[{_LETTER}]+|[{_NUMBER}]"
                         f"|[^\\s{CUT}{_LETTER}{_NUMBER}]+")


_ALL_PLAIN = re.compile(f"[{CUT}{_PLAIN.pattern[1:-2]}]+")


def _as_bytes(words: str) -> str:
    """Words as the model's vocabulary writes them."""
    return charmap_decode(words.encode(), "strict", _BYTES)[0]


class PieceEncoder:
    """Encodes texts to ids, equal to ``Tokenizer.encode(text, add_special_tokens=False)``.

    ``spaces``: "lead" if a space belongs to the word after it (byte-level BPE),
    "drop" if white space only separates (word-end BPE).  As in the library, the string
    of an added token inside a text is that token.  Memory is bounded: pieces are kept in
    two generations of half of ``max_pieces`` pieces or twice ``max_pieces`` ids.  When the
    recent one is full it becomes the older one, whose pieces come back as they are used.
    """

    def __init__(self, path: str, spaces: str, max_pieces: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        if spaces not in ("lead", "drop"):
            raise ValueError(f"spaces: {spaces!r}")
        self.lead = spaces == "lead"
        vocab = self.tokenizer.get_vocab()
        self.begins, self.ends = (np.zeros(max(vocab.values()) + 1, bool) for _ in range(2))
        self.begins[[i for word, i in vocab.items() if word[0] == SPACE]] = True
        self.ends[[i for word, i in vocab.items() if word.endswith(END)]] = True
        if not self.lead:
            (self.mark_id,) = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        # The model alone, for words that need no more normalisation or cutting.  One
        # tokenizer serves for both, since a second one would hold the vocabulary twice.
        self.whole = (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer)
        self.bare = (None, pre_tokenizers.WhitespaceSplit())
        self.mode = self.whole
        self.max_pieces = max_pieces
        self._clear()
        self._age()

    def _age(self) -> None:
        """The recent generation becomes the older one; a new one starts."""
        self.older = (self.slots, self.ids, self.starts, self.counts)
        self._clear()

    def _recall(self, pieces: list) -> list:
        """Take over pieces which the older generation knows; the others."""
        slots, ids, starts, counts = self.older
        at_all = np.fromiter(map(slots.get, pieces, repeat(-1)), np.int64, len(pieces))
        known = np.flatnonzero(at_all >= 0)
        if len(known):
            at, n = at_all[known], counts[at_all[known]]
            some = ids[np.repeat(starts[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            self._add([pieces[i] for i in known.tolist()], some, n)
        return [pieces[i] for i in np.flatnonzero(at_all < 0).tolist()]

    def _clear(self) -> None:
        self.slots: dict = {CUT: 0}             # a part without ids, before every piece
        self.n_slots = 1
        self.ids = np.empty(1 << 16, np.uint32)
        self.starts = np.empty(1 << 14, np.int64)
        self.counts = np.empty(1 << 14, np.int64)
        self.starts[0] = self.counts[0] = 0
        self.used = 0

    def _pieces(self, text: str) -> list:
        """Pieces of one text; a tuple is encoded as it stands, a string with its space."""
        if self.added and self.added.search(text):
            return [(text,)]
        if self.lead:
            if _LOOKAHEAD.search(text):
                first, *rest = _LAST_SPACE.split(text)
                return [(first,), *((f" {p}",) if " " in p else p for p in rest)]
            pieces: list = text.split(" ")
            pieces[0] = (pieces[0],)
            return pieces
        if _SEPARATORS.search(text):
            return [(text,)]
        return text.split() or [("",)]

    def _add(self, pieces: list, ids: np.ndarray, counts: np.ndarray) -> None:
        """Remember new pieces, whose ids stand one after the other in ``ids``."""
        slot = self.n_slots
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while slot + len(pieces) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.empty_like(self.starts)])
            self.counts = np.concatenate([self.counts, np.empty_like(self.counts)])
        self.ids[self.used:self.used + len(ids)] = ids
        self.starts[slot:slot + len(pieces)] = self.used + np.cumsum(counts) - counts
        self.counts[slot:slot + len(pieces)] = counts
        self.used += len(ids)
        self.n_slots += len(pieces)
        self.slots.update(zip(pieces, range(slot, slot + len(pieces)), strict=True))

    def _ids(self, texts: list[str], mode: tuple) -> list[list[int]]:
        if mode is not self.mode:
            self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = self.mode = mode
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _run(self, text: str) -> np.ndarray:
        return np.array(self._ids([text], self.whole)[0], np.uint32)

    def _learn(self, pieces: list) -> None:
        """Remember new pieces: the library encodes the parts it has not seen, and a
        piece of several parts is put together from them."""
        plain = [p for p in pieces if not isinstance(p, tuple)] if self.lead else pieces
        if not self._all_plain(plain):
            plain = [p for p in pieces if not isinstance(p, tuple) and _PLAIN.fullmatch(p)]
        if len(plain) < len(pieces):
            known = set(plain)
            self._encode_new([p for p in pieces if isinstance(p, tuple) or p not in known])
        if not plain:
            return
        if self.lead:
            cut = f"{CUT} "
            parts = _LEAD_PARTS.findall(cut + cut.join(plain))
            keys: list = [p[1:] if p[0] == " " else p if p == CUT else (p,) for p in parts]
        else:
            keys = _DROP_PARTS.findall(CUT + CUT.join(plain).lower())
        at = np.fromiter(map(self.slots.get, keys, repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(at < 0).tolist()
        if new:
            self._encode_words(self._recall(list(dict.fromkeys(keys[i] for i in new))))
            at[new] = [self.slots[keys[i]] for i in new]
        firsts = np.flatnonzero(at == 0)
        sizes = np.diff(np.append(firsts, len(at))) - 1
        single = np.flatnonzero(sizes == 1)                  # the part itself, in lower case
        self.slots.update(zip([plain[i] for i in single.tolist()], at[firsts[single] + 1].tolist(),
                              strict=True))
        joined = np.flatnonzero(sizes > 1)
        if len(joined):
            inner = np.repeat(sizes > 1, sizes + 1)
            n = self.counts[at[inner]]
            starts = np.cumsum(sizes[joined] + 1) - (sizes[joined] + 1)
            self._add([plain[i] for i in joined.tolist()], self._gather(at[inner], n),
                      np.add.reduceat(n, starts))

    @staticmethod
    def _all_plain(pieces: list) -> bool:
        try:
            return bool(_ALL_PLAIN.fullmatch(CUT + CUT.join(pieces)))
        except TypeError:                                    # a tuple among them
            return False

    def _encode_words(self, keys: list) -> None:
        """Encode parts that are one word of the model each."""
        words = [k for k in keys if not isinstance(k, tuple)] if self.lead else keys
        for lo in range(0, len(words), 2000):
            part = words[lo:lo + 2000]
            lead = LEAD if self.lead else ""
            text = _as_bytes(lead + f" {lead}".join(part))
            ids = np.array(self._ids([text], self.bare)[0], np.uint32)
            if self.lead:
                counts = np.diff(np.append(np.flatnonzero(self.begins[ids]), len(ids)))
            else:
                counts = np.diff(np.concatenate([[-1], np.flatnonzero(self.ends[ids])]))
            if len(counts) != len(part):
                raise ValueError("words can't be told apart")
            self._add(part, ids, counts)
        loose = [k for k in keys if isinstance(k, tuple)] if self.lead else []
        if loose:
            # Parts that stand behind another one, without a space.
            ids = self._ids([_as_bytes(k[0]) for k in loose], self.bare)
            self._add(loose, np.array([i for one in ids for i in one], np.uint32),
                      np.array([len(one) for one in ids]))

    def _gather(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self.ids[np.repeat(self.starts[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())]

    def _encode_new(self, pieces: list) -> None:
        """Encode pieces, many in one text where their ends can be told from the ids."""
        plain = [p for p in pieces if not isinstance(p, tuple) and MARK not in p]
        for lo in range(0, len(plain), 1000):
            part = plain[lo:lo + 1000]
            if self.lead:          # each piece holds one space, its first character
                ids = self._run(" " + " ".join(part))
                at = np.flatnonzero(self.begins[ids])
                counts = np.diff(np.append(at, len(ids)))
            else:                  # a mark of one id, in no piece, ends each piece
                ids = self._run(f" {MARK} ".join([*part, ""]))
                at = np.flatnonzero(ids == self.mark_id)
                counts = np.diff(np.concatenate([[-1], at])) - 1
                ids = np.delete(ids, at)
            if len(counts) != len(part):
                raise ValueError("pieces can't be told apart")
            self._add(part, ids, counts)
        for p in pieces:
            if isinstance(p, tuple) or MARK in p:
                ids = self._run(p[0] if isinstance(p, tuple) else " " + p if self.lead else p)
                self._add([p], ids, np.array([len(ids)]))

    def encode(self, texts: list[str], end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order (uint32) and the number of ids per text, ``end_id`` after each."""
        if not texts:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        if len(self.slots) > self.max_pieces // 2 or self.used > 2 * self.max_pieces:
            self._age()
        flat: list = []
        firsts = np.empty(len(texts), np.int64)
        for i, text in enumerate(texts):
            firsts[i] = len(flat)
            flat += self._pieces(text)
        at = np.fromiter(map(self.slots.get, flat, repeat(-1)), np.int64, len(flat))
        new = np.flatnonzero(at < 0).tolist()
        if new:
            self._learn(self._recall(list(dict.fromkeys(flat[i] for i in new))))
            at[new] = list(map(self.slots.__getitem__, [flat[i] for i in new]))
        n = self.counts[at]
        lengths = np.add.reduceat(n, firsts)
        ids = self._gather(at, n)
        if end_id is None:
            return ids, lengths
        ends = np.cumsum(lengths)
        return np.insert(ids, ends, np.uint32(end_id)), lengths + 1


@lru_cache(maxsize=1)
def worker_encoder(path: str, spaces: str, max_pieces: int = 500_000) -> PieceEncoder:
    """This Python worker's encoder: tasks that follow one another in a worker share its
    bounded piece memory."""
    return PieceEncoder(path, spaces, max_pieces)
