"""Piece memory of the tokenisers."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ingot.llm import tokens

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize(("path", "spaces"), [(BYTES, "lead"), (WORDS, "drop")])
def test_strings_of_added_tokens_are_tokens(path, spaces):
    plain = Tokenizer.from_file(path)
    encoder = tokens.PieceEncoder(path, spaces, max_pieces=50)
    texts = [f"{a}{t}{b}" for t in ("<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>")
             for a in ("", "a ", "a", " ", "x<|endoftext|>") for b in ("", " b", "b", "  ")]
    ids, lengths = encoder.encode(texts, 2)
    want = [plain.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert ids.tolist() == [i for w in want for i in w]
    assert lengths.tolist() == [len(w) for w in want]
    assert 50256 in ids.tolist() or 49407 in ids.tolist()


@pytest.mark.parametrize(("path", "spaces"), [(BYTES, "lead"), (WORDS, "drop")])
def test_every_low_character_and_odd_mixtures(path, spaces):
    plain = Tokenizer.from_file(path)
    encoder = tokens.PieceEncoder(path, spaces, max_pieces=2000)
    rng = random.Random(3)
    texts = [x for c in map(chr, range(0x180))
             for x in (c, f"a{c}b", f" {c}{c}", f"x {c}1", f"A'{c}S {c}.", f"{c}  {c} ")]
    texts += ["".join(rng.choice("aéßÿÀ'ſµ²¼٣stllrevmdABC09 .,;-\n\0\1\xad\xa0\x85İǅ")
                      for _ in range(rng.randint(1, 40))) for _ in range(6000)]
    for lo in range(0, len(texts), 40):
        part = texts[lo:lo + 40]
        ids, lengths = encoder.encode(part)
        want = [plain.encode(t, add_special_tokens=False).ids for t in part]
        assert ids.tolist() == [i for w in want for i in w]
        assert lengths.tolist() == [len(w) for w in want]


def test_pieces_used_lately_are_kept():
    encoder = tokens.PieceEncoder(BYTES, "lead", max_pieces=400)
    plain = Tokenizer.from_file(BYTES)
    learned = []
    letters = [a + b for a in "abcdefgh" for b in "abcdefgh"]
    known = encoder._encode_words
    encoder._encode_words = lambda parts: (learned.extend(parts), known(parts))
    for i in range(60):
        text = "start often used " + " ".join(f"rare{letters[i]}{letters[j]}" for j in range(50))
        ids, _ = encoder.encode([text])
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids
    assert learned.count("often") == 1 and learned.count("rareaaab") == 1
    assert len(encoder.slots) <= 400
