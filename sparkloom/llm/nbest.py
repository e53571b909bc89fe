"""N-best segmentation of text into the pieces of a SentencePiece model.

The pieces of a text form a lattice over its characters. A forward Viterbi pass
gives each position the best score of any path from the start. Backward A-star
search then extends partial paths from the end, each rated with its own score
plus the forward score of where it stands; as that is exactly what the rest can
reach, complete paths come out best first and the first N are the N best.

A partial path stands for all paths that share its end, so popping it follows the
best pieces down to the start, which has the same rating, and puts back only the
paths that leave it by the next best piece of some position.

No piece of the model goes from another character to a space mark, so the
lattice falls apart at the starts of words: a word is searched once and its best
path and the loss of its second-best remembered. The N best of a text are the N
best sums over its words, and only the N-1 words whose second-best costs least
can differ from their best in them; these are searched for N.

Defined results: a null text counts as empty; the empty text has one
segmentation, of no pieces; a text with fewer segmentations than N has as many
rows; equal scores come in the order of the search, the same in each run. A
character without a piece becomes its UTF-8 bytes, scored below all pieces.
Decoding an encoded text gives the normalised text back. Repeated rows are encoded
each; a text of any length is encoded whole, by its words, and a word of any length
takes time in proportion to it; an empty table gives an empty result; columns other
than the id and the text, whatever their names, are not looked at.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array as packed_array
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.shared import map_texts, resident, ship, text_of

MARK = "▁"
BEST = 3
# Words remembered, some 200 MB; all are forgotten when there are more.
CACHE_WORDS = 800_000
CACHE_SEARCHED = 50_000
# Texts whose new words are searched in step, such words at a time, and the length
# up to which words are.
TEXTS_IN_STEP = 1024
WORDS_AT_ONCE = 16_384
IN_STEP = 48
TABLE = 64  # symbols with a column in the table of edges, and none
_UNIT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+$")

# Best first: score and ids.
Paths = list[tuple[float, tuple[int, ...]]]
# Of a word: score and ids (as bytes) of its best path, loss of the second-best.
Word = tuple[float, bytes, float]
INFINITE = float("inf")


class Found:
    """What was found for words, by number, in arrays."""

    def __init__(self):
        self.size = 0
        self.scores, self.losses = np.zeros(1024), np.zeros(1024)
        # Where a word's ids start in ``ids``, and where those of the last word end.
        self.starts = np.zeros(1025, dtype=np.int64)
        self.ids = np.zeros(4096, dtype="<u4")

    def add(self, scores: np.ndarray, ids: np.ndarray, sizes: np.ndarray, losses: np.ndarray) -> None:
        """More words: their scores, their ids one behind the other, how many, and losses."""
        at, n = self.size, self.size + len(scores)
        begin = int(self.starts[at])
        end = begin + len(ids)
        while n > len(self.scores):
            self.scores, self.losses = (np.concatenate([a, a]) for a in (self.scores, self.losses))
            self.starts = np.concatenate([self.starts, self.starts[:-1]])
        while end > len(self.ids):
            self.ids = np.concatenate([self.ids, self.ids])
        self.scores[at:n], self.losses[at:n] = scores, losses
        self.starts[at + 1 : n + 1] = begin + np.cumsum(sizes)
        self.ids[begin:end] = ids
        self.size = n


def gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Stretches of an array, one behind the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts - ends + sizes, sizes) + np.arange(total)]


class Segmenter:
    """The pieces and scores of a model, with the words searched so far."""

    def __init__(self, path: str, best: int = BEST):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.best = best
        self.ids: dict[str, int] = {}
        self.pieces: list[str] = []
        self.bytes: dict[int, int] = {}
        self.byte_of: dict[int, int] = {}
        scores = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.pieces.append(piece)
            scores.append(self.model.get_score(i))
            if self.model.is_byte(i):
                value = int(piece[3:-1], 16)
                self.bytes[value], self.byte_of[i] = i, value
            elif not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i)):
                self.ids[piece] = i
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids):
            raise ValueError("a piece of this model holds a space mark behind other characters")
        self.scores = scores
        self.unknown = min(scores[i] for i in self.ids.values()) - 10.0
        self.forget()
        self.searched: dict[str, Paths] = {}
        self.trie = self._trie()
        self._tables()
        spelled = [
            bytes([self.byte_of[i]]) if i in self.byte_of else p.replace(MARK, " ").encode()
            for i, p in enumerate(self.pieces)
        ]
        self.letters = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        self.letter_sizes = np.array([len(p) for p in spelled], dtype=np.int64)
        self.letter_starts = np.cumsum(self.letter_sizes) - self.letter_sizes

    def _trie(self) -> dict:
        """The pieces by their characters: char -> [score, id or -1, next characters]."""
        root: dict = {}
        for piece, i in self.ids.items():
            level = root
            for c in piece[:-1]:
                level = level.setdefault(c, [0.0, -1, {}])[2]
            level.setdefault(piece[-1], [0.0, -1, {}])[:2] = self.scores[i], i
        return root

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.found = Found()

    def _tables(self) -> None:
        """The trie as arrays, for many words in step.

        Symbols number the characters of pieces from 1, the commonest first; nodes
        are numbered from 1, those with edges first, and 0 is none. Edges by the
        commonest symbols are in a table, the others, a node and a symbol in one
        number, in a sorted list.
        """
        share = Counter(c for piece in self.ids for c in piece)
        symbols = sorted(share, key=lambda c: (-share[c], c))
        self.symbol = np.zeros(0x110000, dtype=np.int32)
        self.symbol[[ord(c) for c in symbols]] = np.arange(1, len(symbols) + 1)
        self.width = len(symbols) + 1
        levels = [self.trie]
        for level in levels:
            levels += [further for _, _, further in level.values() if further]
        number = {id(level): i for i, level in enumerate(levels, 1)}
        self.inner = len(levels)
        ids, scores, edges = [-1] * (self.inner + 1), [0.0] * (self.inner + 1), {}
        self.table = np.zeros((self.inner + 1, TABLE), dtype=np.int32)
        for node, level in enumerate(levels, 1):
            for c, (score, i, further) in level.items():
                to = number[id(further)] if further else len(ids)
                if further:
                    ids[to], scores[to] = i, score
                else:
                    ids.append(i)
                    scores.append(score)
                by = int(self.symbol[ord(c)])
                if by < TABLE:
                    self.table[node, by] = to
                else:
                    edges[node * self.width + by] = to
        self.edges = np.array(sorted(edges) or [0], dtype=np.int64)
        self.targets = np.array([edges[e] for e in sorted(edges)] or [0], dtype=np.int32)
        self.node_id, self.node_score = np.array(ids, dtype=np.int32), np.array(scores)

    def _next(self, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Where nodes with edges lead by a symbol each."""
        to = self.table[node, np.where(symbol < TABLE, symbol, 0)]
        rare = np.nonzero(symbol >= TABLE)[0]
        if len(rare):
            key = node[rare] * np.int64(self.width) + symbol[rare]
            place = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            to[rare] = np.where(self.edges[place] == key, self.targets[place], 0)
        return to

    def learn(self, words: Iterable[str]) -> None:
        """Search words, many in step, and remember them.

        The same Viterbi pass as ``forward``, each step for all words at once. Words
        longer than ``IN_STEP`` and those with characters that are no piece are
        left to ``of_word``.
        """
        words = list(words)
        kept = sorted((w for w in words if 0 < len(w) <= IN_STEP), key=len, reverse=True)
        for at in range(0, len(kept), WORDS_AT_ONCE):
            self._learn(kept[at : at + WORDS_AT_ONCE])
        for word in words:
            if word not in self.known:
                score, ids, loss = self.of_word(word)
                ids = np.frombuffer(ids, dtype="<u4")
                self.known[word] = self.found.size
                self.found.add(np.array([score]), ids, np.array([len(ids)]), np.array([loss]))

    def _learn(self, words: list[str]) -> None:
        n, size = len(words), len(words[0])
        lengths = np.array([len(w) for w in words])
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        symbols = np.zeros((size, n), dtype=np.int32)
        column = np.repeat(np.arange(n), lengths)
        row = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        symbols[row, column] = self.symbol[points]
        best = np.full((size + 1, n), INFINITE)
        next_best = np.full((size + 1, n), INFINITE)
        came = np.zeros((size + 1, n), dtype=np.int32)
        piece = np.full((size + 1, n), -1, dtype=np.int32)
        best[0] = 0.0
        # Words stand longest first, so those that reach a position stand in front.
        reach = np.searchsorted(-lengths, -np.arange(size + 1), side="right")
        for start in range(size):
            which = np.arange(int(reach[start + 1]))
            node = self._next(np.ones(len(which), dtype=np.int32), symbols[start, which])
            end = start + 1
            while True:
                alive = node > 0
                which, node = which[alive], node[alive]
                if not len(which):
                    break
                ids = self.node_id[node]
                is_piece = ids >= 0
                w, found = which[is_piece], ids[is_piece]
                score = best[start, w] - self.node_score[node[is_piece]]
                old = best[end, w]
                better = score < old
                next_best[end, w] = np.where(better, old, np.minimum(next_best[end, w], score))
                w, score, found = w[better], score[better], found[better]
                best[end, w], came[end, w], piece[end, w] = score, start, found
                goes_on = (which < reach[min(end + 1, size)]) & (node <= self.inner) & (end < size)
                which, node = which[goes_on], node[goes_on]
                if not len(which):
                    break
                node = self._next(node, symbols[end, which])
                end += 1
        # Back from the ends; words that some piece does not reach are left out.
        whole = np.isfinite(best[lengths, np.arange(n)])
        at, loss = lengths.copy(), np.full(n, INFINITE)
        steps = []
        which = np.nonzero(whole)[0]
        while len(which):
            here = at[which]
            loss[which] = np.minimum(loss[which], next_best[here, which] - best[here, which])
            steps.append((which, piece[here, which]))
            at[which] = came[here, which]
            which = which[at[which] > 0]
        if not steps:
            return
        owner = np.concatenate([w for w, _ in steps[::-1]])
        order = np.argsort(owner, kind="stable")
        flat = np.concatenate([i for _, i in steps[::-1]])[order]
        sizes = np.bincount(owner, minlength=n)[whole]
        done = np.nonzero(whole)[0]
        self.known.update(zip([words[i] for i in done.tolist()], range(self.found.size, self.found.size + len(done))))
        self.found.add(-best[lengths[done], done], flat, sizes, loss[done])

    def lattice(self, word: str) -> list[list[tuple[float, int, int]]]:
        """For each position the pieces that end there, the best way to it first.

        An entry is the forward score through the piece, negated, its start and
        its id; the first entry of a position holds the position's own score.
        """
        size = len(word)
        arcs: list[list[tuple[float, int, int]]] = [[] for _ in word]
        arcs.append([])
        forward = 0.0
        for start in range(size):
            if start:
                arcs[start].sort()
                forward = arcs[start][0][0]
            node = self.trie.get(word[start])
            if node is None or node[1] < 0:
                arcs[start + 1].append((forward - self.unknown, start, -1))
            end = start + 1
            while node is not None:
                if node[1] >= 0:
                    arcs[end].append((forward - node[0], start, node[1]))
                if end == size:
                    break
                node = node[2].get(word[end])
                end += 1
        arcs[size].sort()
        return arcs

    def forward(self, word: str) -> tuple[list[float], list[float], list[int], list[int]]:
        """The Viterbi pass alone: for each position its best score, that of the best
        piece but one to end there, both negated, and start and id of the best piece."""
        size = len(word)
        best, next_best = [INFINITE] * (size + 1), [INFINITE] * (size + 1)
        came, piece = [0] * (size + 1), [-1] * (size + 1)
        best[0] = 0.0
        trie, unknown = self.trie, self.unknown
        for start in range(size):
            here = best[start]
            node = trie.get(word[start])
            end = start + 1
            if node is None or node[1] < 0:
                score = here - unknown
                if score < best[end]:
                    next_best[end], best[end] = best[end], score
                    came[end], piece[end] = start, -1
                elif score < next_best[end]:
                    next_best[end] = score
                if node is None:
                    continue
            while True:
                value, i, further = node
                if i >= 0:
                    score = here - value
                    if score < best[end]:
                        next_best[end], best[end] = best[end], score
                        came[end], piece[end] = start, i
                    elif score < next_best[end]:
                        next_best[end] = score
                if end == size or not further:
                    break
                node = further.get(word[end])
                if node is None:
                    break
                end += 1
        return best, next_best, came, piece

    def search(self, word: str, best: int) -> Paths:
        """The best paths of one word, best first."""
        arcs = self.lattice(word)
        found: Paths = []
        # Entries: rating, number, position, which of its pieces, score and ids behind.
        agenda: list = [(0.0, 0, len(word), 0, 0.0, ())]
        entered = 0
        while agenda and len(found) < best:
            _, _, at, which, behind, path = heapq.heappop(agenda)
            while at:
                here = arcs[at]
                if which + 1 < len(here):
                    entered += 1
                    heapq.heappush(agenda, (here[which + 1][0] - behind, entered, at, which + 1, behind, path))
                _, start, i = here[which]
                path = ((i,) if i >= 0 else self.raw(word[start])) + path
                behind += self.scores[i] if i >= 0 else self.unknown
                at, which = start, 0
            found.append((behind, path))
        return found

    def raw(self, c: str) -> tuple[int, ...]:
        """The pieces of a character's bytes."""
        return tuple(self.bytes.get(b, self.model.unk_id()) for b in c.encode("utf-8", "replace"))

    def normalized(self, text: str) -> str:
        return self.model.normalize(text) if text else ""

    def plain(self, normalized: str) -> str:
        """A normalised text as decoding gives it: with spaces, none in front."""
        plain = normalized.replace(MARK, " ")
        return plain[1:] if plain.startswith(" ") else plain

    def of_word(self, word: str) -> Word:
        """Score, ids and loss of a word, not remembered."""
        # The search up to its second result: the best path, and of the paths
        # that leave it the one with the best rating.
        best, next_best, came, piece = self.forward(word)
        at, ids, loss = len(word), [], INFINITE
        while at:
            less = next_best[at] - best[at]
            if less < loss:
                loss = less
            i = piece[at]
            at = came[at]
            if i >= 0:
                ids.append(i)
            else:
                ids.extend(reversed(self.raw(word[at])))
        ids.reverse()
        return -best[-1], _packed(ids), loss

    def all_nbest(self, texts: list[str]) -> Iterator[tuple[str, list[tuple[float, bytes]]]]:
        """Each text normalised, and its N best segmentations as ``nbest`` gives them."""
        for at in range(0, len(texts), TEXTS_IN_STEP):
            if len(self.known) > CACHE_WORDS:
                self.forget()
            normalized = [self.normalized(t) for t in texts[at : at + TEXTS_IN_STEP]]
            split = [_UNIT.findall(t) for t in normalized]
            numbers = [list(map(self.known.get, words)) for words in split]
            self.learn({w for words, ns in zip(split, numbers) for w, n in zip(words, ns) if n is None})
            known, found = self.known, self.found
            flat = [
                known[w] if n is None else n for words, ns in zip(split, numbers) for w, n in zip(words, ns)
            ]
            which = np.array(flat, dtype=np.int64)
            starts = found.starts[which]
            sizes = found.starts[which + 1] - starts
            ids = gathered(found.ids, starts, sizes).tobytes()
            # Where each word's ids start among these, in bytes.
            bounds = np.concatenate([[0], 4 * np.cumsum(sizes)]).tolist()
            scores, losses = found.scores[which].tolist(), found.losses[which]
            first = 0
            for text, words in zip(normalized, split):
                last = first + len(words)
                yield text, self._of_words(
                    words, scores[first:last], losses[first:last], ids, bounds[first : last + 1]
                )
                first = last

    def nbest(self, text: str) -> list[tuple[float, bytes]]:
        """The N best segmentations of a text, best first: score and ids.

        Ids are little-endian 32-bit numbers, one behind the other.
        """
        return next(self.all_nbest([text]))[1]

    def _of_words(
        self, words: list[str], scores: list[float], losses: np.ndarray, ids: bytes, bounds: list[int]
    ) -> list[tuple[float, bytes]]:
        """The N best of a text from its words' best paths, in ``ids`` from bound to bound."""
        if not words:
            return [(0.0, b"")]
        score, out = sum(scores), []
        for loss, changes in self._ways(words, losses):
            # What lies before, between and behind the words that change.
            parts, done = [], bounds[0]
            for i in sorted(changes):
                parts += [ids[done : bounds[i]], _packed(changes[i])]
                done = bounds[i + 1]
            out.append((score - loss, b"".join([*parts, ids[done : bounds[-1]]])))
        return out

    def _ways(
        self, words: list[str], losses: np.ndarray
    ) -> list[tuple[float, dict[int, tuple[int, ...]]]]:
        """The N cheapest ways to leave the best paths: loss, and the words' other ids."""
        ways: list = [(0.0, (), {})]
        if self.best == 1:
            places = []
        elif len(losses) > 64:
            last = np.partition(losses, self.best - 2)[self.best - 2]
            near = np.nonzero(losses <= last)[0]
            places = near[np.argsort(losses[near], kind="stable")][: self.best - 1].tolist()
        else:
            places = np.argsort(losses, kind="stable")[: self.best - 1].tolist()
        for i in places:
            if losses[i] == INFINITE:
                break
            paths = self.searched.get(words[i])
            if paths is None:
                if len(self.searched) >= CACHE_SEARCHED:
                    self.searched.clear()
                paths = self.searched[words[i]] = self.search(words[i], self.best)
            more = [
                (loss + paths[0][0] - paths[k][0], (*order, k), {**changes, i: paths[k][1]} if k else changes)
                for loss, order, changes in ways
                for k in range(len(paths))
            ]
            more.sort(key=lambda w: w[:2])
            ways = more[: self.best]
        return [(loss, changes) for loss, _, changes in ways]

    def decode(self, ids: Iterable[int]) -> str:
        """The normalised text of pieces, space marks as spaces, none in front."""
        return self.decode_all([_packed(ids)])[0]

    def decode_all(self, many: list[bytes]) -> list[str]:
        """``decode`` of many rows of ids, each packed as little-endian 32-bit numbers."""
        ids = np.frombuffer(b"".join(many), dtype="<u4")
        sizes = self.letter_sizes[ids]
        spelled = gathered(self.letters, self.letter_starts[ids], sizes).tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])
        bounds = ends[np.cumsum([0] + [len(m) // 4 for m in many])].tolist()
        # Bytes of a character stand together again.
        texts = [spelled[a:b].decode("utf-8", "replace") for a, b in zip(bounds, bounds[1:])]
        return [t[1:] if t.startswith(" ") else t for t in texts]


def _packed(ids: Iterable[int]) -> bytes:
    return packed_array("I", ids).tobytes()


def segmenter(path: str, best: int = BEST) -> Segmenter:
    """One for each model and worker."""
    return resident(("pieces", path, best), lambda: Segmenter(path, best))


def encode(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", best: int = BEST,
    digests: bool = False,
) -> DataFrame:
    """Rows (id, rank from 1, score, ids): the best segmentations of each text.

    ``digests`` adds n_pieces, ids_crc32 (of the ids as little-endian 32-bit
    numbers) and round_trip: whether ``decode`` gives the normalised text.
    """

    def work(texts: list[str]) -> tuple[list[int], dict]:
        own = segmenter(path, best)
        rows, ranks, scores, ids, plain = [], [], [], [], []
        for row, (text, found) in enumerate(own.all_nbest(texts)):
            for rank, (score, pieces) in enumerate(found, 1):
                rows.append(row)
                ranks.append(rank)
                scores.append(score)
                ids.append(pieces)
            if digests:
                plain += [own.plain(text)] * len(found)
        sizes = np.array([len(i) // 4 for i in ids], dtype=np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        flat = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
        columns = {"rank": ranks, "score": scores, "ids": pa.ListArray.from_arrays(pa.array(ends), flat)}
        if digests:
            columns |= {
                "n_pieces": sizes,
                "ids_crc32": [zlib.crc32(i) for i in ids],
                "round_trip": [a == b for a, b in zip(own.decode_all(ids), plain)],
            }
        return rows, columns

    fields = "rank int, score double, ids array<int>"
    if digests:
        fields += ", n_pieces bigint, ids_crc32 bigint, round_trip boolean"
    named = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    return map_texts(named, work, fields).withColumnRenamed("_id", id_col)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """The rows with ``text``, what the pieces spell; null pieces give a null text."""
    ship(encoded.sparkSession)
    @F.pandas_udf("string")
    def spell(ids: pd.Series) -> pd.Series:
        own = segmenter(path)
        texts = iter(own.decode_all([_packed(i) for i in ids if i is not None]))
        return pd.Series([None if i is None else next(texts) for i in ids], dtype=object)

    return encoded.withColumn("text", spell(ids_col))
