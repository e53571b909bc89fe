"""Language of texts by cross-parsing against labelled text.

For each language a suffix automaton of sampled labelled text recognises all its
substrings. A text is parsed against it: from each point the longest substring
that the language's sample has is one phrase, and the next starts behind it. The
language that needs the fewest phrases, each weighted with the bits of a
pointer into its sample, wins.

Texts are folded to letters in lower case with single spaces for everything
between them. Every letter of the samples is a symbol of its own; letters that no
sample has match nothing. The automata are dense tables over the commonest symbols
and a sorted list of edges for the others, so scripts of thousands of letters take
no wider tables. A batch of texts is parsed in step, one symbol of all texts and
languages at a time. Long texts are cut into blocks of ``BLOCK`` symbols for that,
all begun at once as if a phrase began with each; then those in which one was
under way are parsed again from there, until the two parses meet. So the phrases
are those of the whole text, whatever the block.

The sample is bounded: per language the ``SAMPLE_ROWS`` labelled rows with the
smallest hashes of their ids, and of their texts ``SAMPLE_SYMBOLS`` symbols, an even
share of each row and what short rows leave from the longer ones. Only the sample
travels to the tasks; each worker builds the automata once. For each language that
is some 5 MB at the driver at most, 160 KB in the job and 30 MB in a worker, so the
number of languages should stay below a hundred or so.

Defined results: a null text, or one without a letter, is "und" with score 0; a
tie goes to the first language by name; rows without a label teach nothing; if
nothing can be learnt, every text is "und". The answer is a function of the text, so
repeated rows have equal ones. Texts of any length are read whole; an empty table
gives an empty result; columns other than the id, the text and the language,
whatever their names, are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from sparkloom.llm.shared import crc_mod, map_texts, resident, text_of

SAMPLE_ROWS = 64
SAMPLE_SYMBOLS = 40_000
BLOCK = 1024
DENSE = 64  # the space and the letters that have a column in the tables
SHARPNESS = 12.0


@cache
def folded() -> np.ndarray:
    """For each code point its letter in lower case, 0 for all that is no letter."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            low = c.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def letters(text: str) -> np.ndarray:
    """The folded text: letters, and 0 between words, not at the ends."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    points = folded()[points]
    space = points == 0
    if space.any():
        drop = space.copy()
        drop[1:] &= space[:-1]
        points = points[~drop]
        if len(points) and points[-1] == 0:
            points = points[:-1]
    return points


class Alphabet:
    """Symbols: 0 for the space, then a number for each letter, the commonest first.

    Letters that are not among them share the symbol ``size``, which no sample has.
    """

    def __init__(self, letters_: list[int]):
        self.size = 1 + len(letters_)
        self.table = np.full(0x110000, self.size, dtype=np.int32)
        self.table[0] = 0
        self.table[letters_] = np.arange(1, self.size)

    def symbols(self, points: np.ndarray) -> np.ndarray:
        return self.table[points]


def automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton by state: state 1 is the start, 0 is none."""
    step: list[dict[int, int]] = [{}, {}]
    link, length = [0, 0], [0, 0]
    last = 1
    for c in symbols:
        new = len(step)
        step.append({})
        link.append(1)
        length.append(length[last] + 1)
        p = last
        while p and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return step


class Parser:
    """The automata of all languages in one table, and the parse in step."""

    def __init__(self, samples: dict[str, str]):
        self.names = sorted(samples)
        folds = {n: letters(samples[n])[:SAMPLE_SYMBOLS] for n in self.names}
        # Counted by language, so that a large one does not fill the alphabet.
        share: Counter[int] = Counter()
        for points in folds.values():
            values, counts = np.unique(points[points > 0], return_counts=True)
            for v, k in zip(values.tolist(), counts.tolist()):
                share[v] += k / max(1, len(points))
        known = [p for p, _ in sorted(share.items(), key=lambda x: (-x[1], x[0]))]
        self.alphabet = Alphabet(known)
        self.starts, self.bits = [], []
        tables, edges, at = [], [], 0
        for n in self.names:
            steps = automaton(self.alphabet.symbols(folds[n]).tolist())
            table = np.zeros((len(steps), DENSE), dtype=np.int32)
            for state, moves in enumerate(steps):
                for c, to in moves.items():
                    if c < DENSE:
                        table[state, c] = to + at
                    else:
                        edges.append((self._edge(state + at, c), to + at))
            tables.append(table)
            self.starts.append(at + 1)
            at += len(steps)
            self.bits.append(math.log2(max(2, len(folds[n]))))
        self.moves = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)
        edges.sort()
        self.edges = np.array([e for e, _ in edges], dtype=np.int64)
        self.targets = np.array([to for _, to in edges], dtype=np.int64)

    def _edge(self, state, symbol):
        return state * (self.alphabet.size + 1) + symbol

    def _move(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Where each state goes with its symbol; 0 where it has no such edge."""
        to = self.moves[state * DENSE + np.minimum(symbol, DENSE - 1)].astype(np.int64)
        rare = np.nonzero(np.broadcast_to(symbol >= DENSE, to.shape))
        if len(rare[0]):
            keys = self._edge(state, symbol)[rare]
            place = np.searchsorted(self.edges, keys)
            place[place == len(self.edges)] = 0
            hit = self.edges[place] == keys if len(self.edges) else np.zeros(len(keys), bool)
            to[rare] = np.where(hit, self.targets[place] if len(self.edges) else 0, 0)
        return to

    def _step(
        self, state: np.ndarray, symbol: np.ndarray, start: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """The states after one more symbol, and where a phrase began with it."""
        to = self._move(state, symbol)
        failed = to == 0
        # A phrase begins where none is under way or the last one ends.
        begins = failed | (state == start)
        if failed.any():
            # A symbol the sample lacks is a phrase by itself.
            again = self._move(np.broadcast_to(start, to.shape), symbol)
            to = np.where(failed, np.where(again == 0, start, again), to)
        return to, begins

    def phrases(self, coded: list[np.ndarray]) -> np.ndarray:
        """Phrases of each coded text (rows) in each language (columns)."""
        owner, blocks = [], []
        for i, symbols in enumerate(coded):
            for at in range(0, len(symbols), BLOCK):
                owner.append(i)
                blocks.append(symbols[at : at + BLOCK])
        k = len(self.names)
        total = np.zeros((len(coded), k), dtype=np.int64)
        if not blocks or not k:
            return total
        sizes = np.array([len(b) for b in blocks])
        # Longest first, so that those under way stand together.
        order = np.argsort(-sizes, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        grid = np.zeros((int(sizes.max()), len(blocks)), dtype=np.int32)
        for column, b in enumerate(order):
            grid[: sizes[b], column] = blocks[b]
        active = np.searchsorted(-sizes[order], -np.arange(len(grid)), side="left")
        start = np.array(self.starts, dtype=np.int64)[:, None]
        state = np.repeat(start, len(blocks), axis=1)
        count = np.zeros((k, len(blocks)), dtype=np.int64)
        for t in range(len(grid)):
            m = int(active[t])
            state[:, :m], begins = self._step(state[:, :m], grid[t, :m].astype(np.int64), start)
            count[:, :m] += begins
        # Blocks that follow another, and the state in which that one ends.
        owners = np.array(owner)
        follows = np.nonzero(owners[1:] == owners[:-1])[0] + 1
        language = np.repeat(np.arange(k), len(follows))
        before, column = np.tile(place[follows - 1], k), np.tile(place[follows], k)
        block = np.tile(follows, k)
        entered = state[language, before]
        more, ends = np.zeros_like(count), state.copy()
        while len(column):
            ended = self._resumed(grid, sizes[order], language, column, entered, more)
            ended = np.where(ended < 0, state[language, column], ended)
            # Where a block now ends in another state, the one behind it is wrong.
            wrong = np.nonzero(ended != ends[language, column])[0]
            ends[language, column] = ended
            behind = block[wrong] + 1
            goes_on = behind < len(blocks)
            goes_on[goes_on] = owners[behind[goes_on]] == owners[behind[goes_on] - 1]
            wrong, block = wrong[goes_on], behind[goes_on]
            language, entered = language[wrong], ended[wrong]
            column = place[block]
        np.add.at(total, owners[order], (count + more).T)
        return total

    def _resumed(
        self, grid: np.ndarray, sizes: np.ndarray, language: np.ndarray, column: np.ndarray,
        entered: np.ndarray, more: np.ndarray,
    ) -> np.ndarray:
        """Parse blocks again, each from the state it is entered in, until that parse
        meets the one from the block's start.

        ``more`` is set to the phrases to add to those of the latter. Returns the
        states at the ends of blocks whose parses never met, else -1.
        """
        start = np.array(self.starts, dtype=np.int64)[language]
        ended = np.full(len(column), -1, dtype=np.int64)
        fixed = np.zeros(len(column), dtype=np.int64)
        fresh, now = start.copy(), entered.copy()
        left = np.arange(len(column))
        t = 0
        while len(left):
            symbol = grid[t, column[left]].astype(np.int64)
            fresh, first = self._step(fresh, symbol, start[left])
            now, second = self._step(now, symbol, start[left])
            fixed[left] += second.astype(np.int64) - first
            t += 1
            met = fresh == now
            over = ~met & (t >= sizes[column[left]])
            ended[left[over]] = now[over]
            go = ~met & ~over
            left, fresh, now = left[go], fresh[go], now[go]
        more[language, column] = fixed
        return ended

    def classify(self, texts: list[str]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = []
        for at in range(0, len(texts), 2048):
            out += self._some(texts[at : at + 2048])
        return out

    def _some(self, texts: list[str]) -> list[tuple[str, float]]:
        coded = [self.alphabet.symbols(letters(t)) for t in texts]
        size = np.array([len(c) for c in coded])
        if not self.names:
            return [("und", 0.0)] * len(texts)
        cost = self.phrases(coded) * np.array(self.bits) / np.maximum(size, 1)[:, None]
        best = cost.argmin(axis=1)
        least = cost.min(axis=1)
        share = 1 / np.exp(-SHARPNESS * (cost - least[:, None])).sum(axis=1)
        return [
            (self.names[b], float(s)) if n else ("und", 0.0)
            for b, s, n in zip(best, share, size)
        ]


def parser(samples: dict[str, str]) -> Parser:
    """One for each sample and worker."""
    return resident(("parser", *sorted(samples.items())), lambda: Parser(samples))


def sample(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> dict[str, str]:
    """Sampled text of each language, bounded by rows and symbols.

    The rows are chosen by id, without their texts; Spark keeps the first ones
    of each language before the shuffle.
    """
    learnt = docs.filter(
        F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (crc_mod(id_col, 4) != 2)
    )
    order = Window.partitionBy("_lang").orderBy("_hash", "_id")
    chosen = (
        learnt.select(F.col(lang_col).alias("_lang"), F.col(id_col).alias("_id"))
        .withColumn("_hash", F.xxhash64("_id"))
        .withColumn("_place", F.dense_rank().over(order))
        .filter(F.col("_place") <= SAMPLE_ROWS)
        .select("_lang", "_id", "_hash")
        .distinct()
    )
    rows = (
        learnt.select(
            F.col(lang_col).alias("_lang"),
            F.col(id_col).alias("_id"),
            F.substring(text_col, 1, SAMPLE_SYMBOLS).alias("_text"),
        )
        .join(F.broadcast(chosen), ["_lang", "_id"])
        .groupBy("_lang", "_id", "_hash")
        .agg(F.min("_text").alias("_text"))
        .collect()
    )
    texts: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["_lang"], r["_hash"], r["_text"])):
        texts.setdefault(r["_lang"], []).append(r["_text"])
    shared = {lang: _shared_out(parts, SAMPLE_SYMBOLS) for lang, parts in texts.items()}
    return {lang: text for lang, text in shared.items() if text}


def _shared_out(texts: list[str], symbols: int) -> str:
    """The folded texts' first symbols, as many of each, in all ``symbols`` at most.

    What a short text leaves of its share goes to the longer ones.
    """
    folds = [f for f in map(letters, texts) if len(f)]
    share: dict[int, int] = {}
    left = symbols
    for place, i in enumerate(sorted(range(len(folds)), key=lambda i: len(folds[i]))):
        share[i] = min(len(folds[i]), left // (len(folds) - place))
        left -= share[i]
    spelled = [
        "".join(map(chr, np.where(f == 0, 32, f)[: share[i]].tolist())) for i, f in enumerate(folds)
    ]
    return " ".join(t for t in spelled if t)


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """One row per row: the id, held_out, lang_pred and score."""
    samples = sample(docs, id_col, text_col, lang_col)

    def work(texts: list[str]) -> tuple[None, dict]:
        answers = parser(samples).classify(texts)
        return None, {"lang_pred": [a for a, _ in answers], "score": [s for _, s in answers]}

    named = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    answered = map_texts(named, work, "lang_pred string, score double")
    return answered.select(
        F.col("_id").alias(id_col),
        (crc_mod("_id", 4) == 2).alias("held_out"),
        "lang_pred",
        "score",
    )
