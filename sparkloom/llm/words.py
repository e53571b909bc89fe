"""Token ids of whole texts by a byte-pair tokenizer that marks the ends of words.

White space never joins two words, so a text's ids are those of its words, one
behind the other, and words repeat: each is tokenized once and remembered.

A new word of ASCII, or of Latin letters and marks behind them, is cut as the
tokenizer's pattern does, and its byte pairs are merged by tiktoken, which takes the adjacent pair
whose bytes together are the token of the lowest rank. The end mark is written as
a space, a byte that no word holds; a last byte with its mark has a lower rank than
any merge, so they join first. That equals the tokenizer's own merges provided that
every token, merged alone, becomes itself: a pair stands side by side in a word
only after the same merges that its bytes alone go through, so if the tokenizer
did not join this pair, it would not make the token from its bytes either. Tokens
that fail are left out of the ranks; the tokenizer never makes them. Other words,
and a file of another kind, go to the tokenizer itself.
"""

from __future__ import annotations

import json
import os
import re
import string
import unicodedata
from array import array as packed_array
from collections.abc import Iterator

import numpy as np

from sparkloom.llm.shared import resident

# Words remembered: twice as many at most, those used since the last change kept.
CACHE_WORDS = 400_000
END_OF_WORD = "</w>"
# Fixed value: how the tokenizer's file cuts words.
WORD_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
# The same for words of ASCII in lower case.
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\\sa-z0-9]+")
_PUNCTUATION = string.punctuation
# Letters up to U+024F, on which Python and the tokenizer agree in any version.
_LATIN = re.compile("[a-zªµºß-öø-ɏ]+")
# Controls that split() takes for white space and the tokenizer does not.
_CONTROLS = "\x1c\x1d\x1e\x1f"


def _byte_of_char() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes.

    Printable ones of Latin-1 stand for themselves, the others for those from
    U+0100 on, in order.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _reachable(vocab: dict[str, int], merges: list[tuple[str, str]]) -> set[str]:
    """The tokens that become themselves when their characters are merged alone."""
    from tokenizers.models import BPE

    found = set()
    for ends in (False, True):
        model = BPE(vocab, merges, **({"end_of_word_suffix": END_OF_WORD} if ends else {}))
        for token in vocab:
            if token.endswith(END_OF_WORD) == ends:
                made = model.tokenize(token.removesuffix(END_OF_WORD))
                if len(made) == 1 and made[0].value == token:
                    found.add(token)
    return found


def _merger(path: str):
    """A function from the bytes of a word part and a space to ids, or None.

    None if the file is not of the kind this module knows.
    """
    from tiktoken import Encoding

    with open(path, encoding="utf-8") as source:
        file = json.load(source)
    model, before = file["model"], file.get("pre_tokenizer") or {}
    cuts = [p for p in before.get("pretokenizers", []) if p["type"] == "Split"]
    if (
        model.get("type") != "BPE"
        or model.get("end_of_word_suffix") != END_OF_WORD
        or [c["pattern"].get("Regex") for c in cuts] != [WORD_PATTERN]
        or [p["type"] for p in before["pretokenizers"]] != ["Split", "ByteLevel"]
        or before["pretokenizers"][1].get("use_regex", True)
        or before["pretokenizers"][1].get("add_prefix_space", True)
    ):
        return None
    vocab, byte_of = model["vocab"], _byte_of_char()
    merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    whole = _reachable(vocab, merges)
    # A pair's rank is that of its merge; ids must rise with the merges for that.
    order = [vocab[a + b] for a, b in merges if a + b in whole]
    single = [vocab[t] for t in whole if len(t.removesuffix(END_OF_WORD)) == 1]
    if order != sorted(order) or max(single) >= min(order):
        return None
    ranks = {}
    for token in whole:
        body = token.removesuffix(END_OF_WORD)
        spelled = bytes(byte_of[c] for c in body) + (b" " if body != token else b"")
        ranks[spelled] = vocab[token]
    if any(bytes([b]) not in ranks or bytes([b, 32]) not in ranks for b in range(256)):
        return None
    encoding = Encoding("words", pat_str=r"\S+ ", mergeable_ranks=ranks, special_tokens={})
    return encoding._core_bpe.encode_single_piece


class _Known(dict):
    """Words and their ids as bytes; a word that is missing is tokenized."""

    def __init__(self, tokenizer: WordTokenizer, older: dict[str, bytes]):
        self.tokenizer, self.older = tokenizer, older

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.tokenizer.word(word)
        self[word] = ids
        return ids


class WordTokenizer:
    """Ids of texts, the same as those of the tokenizer for the whole text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = _merger(path)
        self.known = _Known(self, {})

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def word(self, word: str) -> bytes:
        """The ids of a word in lower case."""
        if self.merge is None:
            return self.whole(word)
        letters = word.rstrip(_PUNCTUATION)
        if letters.isalpha() and (letters.isascii() or _LATIN.fullmatch(letters)):
            parts = [letters, word[len(letters) :]] if len(letters) < len(word) else [letters]
        elif word.isascii():
            parts = _PARTS.findall(word)
        else:
            return self.whole(word)
        ids: list[int] = []
        for part in parts:
            ids += self.merge((part + " ").encode())
        return packed_array("I", ids).tobytes()

    def texts(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit numbers."""
        for t in texts:
            if len(self.known) > CACHE_WORDS:
                self.known = _Known(self, dict(self.known))
            if not t.isascii() and not unicodedata.is_normalized("NFC", t):
                yield self.whole(t)
            elif "<|" in t or any(c in t for c in _CONTROLS):
                yield self.whole(t)
            else:
                # The tokenizer lower-cases character by character.
                lower = "".join(map(str.lower, t)) if "Σ" in t or "İ" in t else t.lower()
                yield b"".join(map(self.known.__getitem__, lower.split()))


def tokenizer(path: str) -> WordTokenizer:
    """One for each file and worker."""
    return resident(("words", path), lambda: WordTokenizer(path))
