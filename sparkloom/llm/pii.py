"""Personal data: generous candidates, boosted trees, calibrated thresholds.

Spans that match a fixed format and its validity rule (``base_spans``) are always
taken. Around them generators propose, for any text, overlapping candidates in
looser formats: addresses with a written "at" or "dot", telephone numbers
without a country code, cards and network addresses with other separators. In a
stretch of digit groups every run of whole groups with the digits of a telephone
number or a card is proposed, so lists of numbers, and numbers beside a date or
a base span, hold their candidates. Each candidate becomes a vector of format and
context features, boosted trees give it a probability, and it is taken if that
passes the threshold of its kind.

The trees learn from every row of the corpus and its whole text. Each base span is
rewritten in place, in the looser formats as an example and as look-alikes (dates,
versions, amounts, order numbers, card numbers with a wrong check digit) as a
counter-example, numbers also in lists and beside dates, short numbers and the span
itself; all other candidates found in the texts count as counter-examples. A fifth
of the texts, by a hash, is kept back to set the thresholds: the lowest probability,
in steps of 1 / ``STEPS``, from which on the share of wrong ones is at most
``MISTAKES``. The examples stay in Spark's tasks; what comes to the driver are sums
over them.

Defined results: a null text is empty and has no spans; positions are code
points, the end exclusive; spans of different kinds may overlap, base ones of
one kind do not, and an added span overlaps no other span. If the corpus has no
base span, nothing is learnt and nothing is added. Texts of any length are read
whole; repeated rows have equal results; an empty table gives an empty result; other
columns pass, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.boosting import QUANTILES, Boosted, Spread
from sparkloom.llm.shared import boxed, keep, map_texts, resident, ship, text_of

KINDS = ("email", "ip", "card", "phone")
MISTAKES = 0.02
STEPS = 1 << 14  # between the probabilities 0 and 1
# Examples made at a time, and examples of a block that the trees read at a time.
MADE = 1 << 14
IN_BLOCK = 1 << 16
AROUND = 80  # characters of context
SCORED = 20_000  # candidates scored at a time

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")  # taken whole, so linear
_NUMBER = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from their signs: linear in the text."""
    done, sign = 0, text.find("@")
    floor = 0
    while sign >= 0:
        before = text[max(done, floor) : sign]
        start = sign - (len(before) - len(before.rstrip(_LOCAL)))
        match = _DOMAIN.match(text, sign + 1) if start < sign else None
        if match:
            yield start, match.end()
            done = match.end()
        floor = sign + 1
        sign = text.find("@", max(floor, done))


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers joined by dots, taken in order from each dotted run."""
    for run in _DOTTED.finditer(text):
        if run[0].count(".") < 3:
            continue
        parts = [(m.start(), m.end()) for m in _NUMBER.finditer(text, run.start(), run.end())]
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            if all(e - s <= 3 or not text[s : e - 3].strip("0") for s, e in four) and all(
                int(text[max(s, e - 3) : e]) <= 255 for s, e in four
            ):
                yield four[0][0], four[3][1]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans (start, end, kind) of the fixed formats, by start, then kind."""
    found = []
    if "@" in text:
        found += [(s, e, 0) for s, e in _emails(text)]
    if _NUMBER.search(text):
        found += [(s, e, 1) for s, e in _addresses(text)]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = _NOT_DIGIT.sub("", m[0])
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), m.end(), 2))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    found.append((m.start(), m.end(), 3))
    return [(s, e, KINDS[k]) for s, e, k in sorted(found, key=lambda x: (x[0], x[2]))]


# Generators. Names, hosts and stretches may have any length; each is read once, so
# the time is linear in the text.
_AT = re.compile(r" ?\[at\] ?| ?\(at\) ?| at |@", re.I)
_LABEL = re.compile(r"[A-Za-z0-9-]+")
_NEXT_LABEL = re.compile(r"(?:\.| ?\[dot\] ?| ?\(dot\) ?| dot )[A-Za-z0-9-]+", re.I)
# Of a host's beginnings so many are proposed, besides the whole host.
HOST_LABELS = 5
_STRETCH = re.compile(r"[0-9](?:[ ().,/_-]{0,2}[0-9])+")
_LOOSE_IP = re.compile(r"[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|[.,:_-])[0-9]{1,3}){3}")

# Words that announce a kind, and common last labels of hosts.
_CUES = {
    "email": ("mail", "contact", "write", "reach", "address"),
    "ip": ("ip", "host", "server", "address", "ping"),
    "card": ("card", "visa", "mastercard", "credit", "debit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "cell", "fax", "dial"),
}
_ENDINGS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk")


def _runs(text: str) -> Iterator[tuple[int, int, str]]:
    """Runs of whole digit groups with the digits of a telephone number or a card.

    A run has 19 groups at most, so there are a bounded number for each group.
    """
    for stretch in _STRETCH.finditer(text):
        if stretch.end() - stretch.start() < 7:
            continue
        groups = [m.span() for m in _NUMBER.finditer(text, stretch.start(), stretch.end())]
        for i, (start, _) in enumerate(groups):
            start -= text[start - 1 : start] == "("
            start -= text[start - 1 : start] == "+"
            digits = 0
            for s, e in groups[i : i + 19]:
                digits += e - s
                if digits > 19:
                    break
                if 7 <= digits <= 15:
                    yield start, e, "phone"
                if digits >= 12:
                    yield start, e, "card"


def _loose_emails(text: str) -> Iterator[tuple[int, int]]:
    """Names and hosts joined by a written or spoken "at": the host's first labels, one
    by one, and the whole host."""
    # Where the host ends that goes on behind a place; hosts may share their ends.
    whole: dict[int, int] = {}
    done = 0
    for m in _AT.finditer(text):
        name = text[done : m.start()]
        size = len(name) - len(name.rstrip(_LOCAL))
        done = m.end()
        label = _LABEL.match(text, done) if size else None
        if not label or label.start() == label.end():
            continue
        start, end = m.start() - size, label.end()
        passed = []
        while True:
            if passed and len(passed) < HOST_LABELS:
                yield start, end
            if end in whole:
                last = whole[end]
                break
            passed.append(end)
            label = _NEXT_LABEL.match(text, end)
            if not label:
                last = end
                break
            end = label.end()
        for place in passed:
            whole[place] = last
        if passed[0] != last and last not in passed[1:HOST_LABELS]:
            yield start, last


def candidates(text: str) -> list[tuple[int, int, str]]:
    """All proposals, overlapping ones included."""
    found = [(s, e, "email") for s, e in _loose_emails(text)]
    for m in _NUMBER.finditer(text):
        ip = _LOOSE_IP.match(text, max(m.start(), m.end() - 3))
        if ip:
            found.append((*ip.span(), "ip"))
    found += _runs(text)
    return found


FEATURES = 36
_JOINT = re.compile(r"([ ().,:/_-]{0,2})([0-9]{1,19})")


def _looseness(between: str) -> float:
    """1 for nothing, 2 for one tight mark, 3 for a space, 4 for others."""
    if len(between) > 1 or between == ",":
        return 4.0
    return 1.0 + len(between) + (between == " ")


def _joints(text: str, start: int, end: int, kind: str) -> list[float]:
    """What joins the span to digits before and after it and their number; also inside."""
    if kind == "email":
        return [0.0, 0.0, float(bool(_NEXT_LABEL.match(text, end))), 0.0, 0.0, 0.0]
    out = []
    for m in (_JOINT.match(text[max(0, start - 21) : start][::-1]), _JOINT.match(text, end)):
        out += [_looseness(m[1]), float(len(m[2]))] if m else [0.0, 0.0]
    inside = {x for x in _NUMBER.split(text[start:end])[1:-1]}
    return [*out, float(len(inside)), max(map(_looseness, inside), default=0.0)]


def features(text: str, start: int, end: int, kind: str) -> list[float]:
    span = text[start:end]
    digits = _NOT_DIGIT.sub("", span)
    groups = [len(g) for g in _NUMBER.findall(span)] or [0]
    parts = [int(g) for g in _NUMBER.findall(span) if len(g) <= 4] or [0]
    before = text[max(0, start - AROUND) : start].lower()
    words = re.findall(r"[^\W\d_]+", before)[-4:]
    own = _CUES[kind]
    cue = max((i + 1 for i, w in enumerate(words) if any(w.startswith(c) for c in own)), default=0)
    last = re.split(r"[^A-Za-z0-9]+", span)[-1].lower()
    marks = re.search(r"\[at\]|\(at\)|@", span, re.I)
    left = text[start - 1] if start else " "
    right = text[end] if end < len(text) else " "
    return [
        *[float(kind == k) for k in KINDS],
        len(span), len(digits), len(digits) / len(span), len(groups), max(groups), min(groups),
        groups[0], groups[-1],
        float(span[0] == "+"), float("(" in span), span.count("."), span.count("-"),
        span.count(" "), span.count("/"), span.count(","), span.count("_"),
        float(12 <= len(digits) <= 19 and luhn(digits)),
        float(bool(marks)), float("dot" in span.lower()), float(last in _ENDINGS),
        float(left.isalnum()), float(right.isalnum()),
        cue, max(parts), float(1900 <= parts[0] <= 2100), float(digits[:2] == "00"),
        *_joints(text, start, end, kind),
    ]


def _rewritten(span: str, kind: str) -> tuple[list[str], list[str]]:
    """Looser forms of a span, and look-alikes that are none."""
    digits = _NOT_DIGIT.sub("", span)
    if kind == "email":
        name, _, host = span.partition("@")
        # Names and hosts also without their digits, which prove nothing.
        plain, bare = (re.sub(r"[._-]?[0-9]+", "", x) or x for x in (name, host))
        good, bad = [], []
        for n, h in ((name, host), (plain, host), (plain, bare), (f"{plain}.{plain}", bare)):
            spoken = h.replace(".", " dot ")
            good += [f"{n}[at]{h}", f"{n} [at] {h}", f"{n} (at) {h}", f"{n} at {spoken}", f"{n} [at] {spoken}"]
            bad += [f"{n} at {h.split('.')[0]}.{n}", f"{n.split('.')[0]} at {h.split('.')[0]}", f"at {n}. {h}"]
        return good, bad
    if kind == "ip":
        four = span.split(".")
        wrong = [str(256 + int(p) % 700) for p in four]
        return (
            ["[.]".join(four), "(.)".join(four)],
            [".".join(wrong), ",".join(four), "-".join(four), ":".join(four), ".".join(four[:3])],
        )
    if kind == "card":
        off = digits[:-1] + str((int(digits[-1]) + 3) % 10)
        fours = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return (
            [".".join(fours), "/".join(fours), "_".join(fours)],
            [off, ".".join(off[i : i + 4] for i in range(0, len(off), 4)), digits[:10], f"{digits[:4]},{digits[4:7]},{digits[7:10]}"],
        )
    rest = digits[-10:]
    a, b, c = rest[:-7], rest[-7:-4], rest[-4:]
    year, month, day = 1950 + int(rest[-2:]) % 80, 1 + int(c) % 12, 1 + int(b) % 28
    return (
        [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{digits}", f"00{digits[:-10] or '1'} {a} {b} {c}"],
        [
            f"{year}-{month:02d}-{day:02d}", f"{day:02d}/{month:02d}/{year}", f"{year}-{year + 9}",
            f"{day}.{month}.{rest[-6:]}", rest[-8:], f"{a},{b},{c}", f"{digits[:3]}.{rest}",
            f"{year}-{month:02d}-{day:02d} {day % 24:02d}.{month:02d}",
        ],
    )


def _lists(span: str, good: list[str], bad: list[str]) -> Iterator[list[tuple[str, bool]]]:
    """Forms of a number beside others, as pieces; marked ones are examples."""
    seed = int(_NOT_DIGIT.sub("", span)[-6:])
    date = f"{1950 + seed % 80}-{1 + seed % 12:02d}-{1 + seed % 28:02d}"
    for i, form in enumerate(good):
        one = (form, True)
        yield [
            [one, (", ", False), one],
            [(f"{date}, ", False), one],
            [(f"{seed % 100} ", False), one],
            [(f"{span}, ", False), one],
            [one, (" ", False), one],
            [one, (f", {date[:4]}", False)],
            [one, (", ", False), one, (", ", False), one],
            [one, (f" {date}", False)],
        ][(seed + i) % 8]
    for i in range(seed % 2, len(bad), 2):
        yield [(f"{bad[i - 1]}, {bad[i]}", False)]


def examples(text: str, base: list[tuple[int, int, str]]) -> Iterator[tuple[list[float], float]]:
    """Features and labels made of one text."""
    for s, e, kind in base:
        head, tail = text[max(0, s - AROUND) : s], text[e : e + AROUND]
        good, bad = _rewritten(text[s:e], kind)
        places = [[(form, True)] for form in good] + [[(form, False)] for form in bad]
        if kind != "email":
            places += _lists(text[s:e], good, bad)
        for pieces in places:
            new, right = head, set()
            for piece, marked in pieces:
                if marked:
                    right.add((len(new), len(new) + len(piece), kind))
                new += piece
            at, to = len(head), len(new)
            new += tail
            covered = Covered(base_spans(new))
            for c in candidates(new):
                if c[0] < to and c[1] > at and not covered.meets(c[0], c[1]):
                    yield features(new, *c), float(c in right)
    covered = Covered(base)
    for c in candidates(text):
        if not covered.meets(c[0], c[1]):
            yield features(text, *c), 0.0


class Covered:
    """Stretches of a text, to ask whether a span meets one of them."""

    def __init__(self, spans: list[tuple[int, int, str]] = ()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for s, e, *_ in sorted(spans):
            if self.ends and s < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s)
                self.ends.append(e)

    def meets(self, start: int, end: int) -> bool:
        i = bisect_left(self.starts, end) - 1
        return i >= 0 and self.ends[i] > start

    def add(self, start: int, end: int) -> None:
        """A span that meets none."""
        i = bisect_left(self.starts, start)
        self.starts.insert(i, start)
        self.ends.insert(i, end)


class Redactor:
    """The fitted trees and the threshold of each kind."""

    def __init__(self, model: Boosted | None, thresholds: dict[str, float]):
        self.model, self.thresholds = model, thresholds

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        return self.all_spans([text])[0][1]

    def all_spans(self, texts: list[str]) -> list[tuple[list, list]]:
        """For each text its base spans and all spans, scored in one go."""
        bases = [base_spans(t) for t in texts]
        likely: list[tuple] = []
        offered, vectors = [], []

        def score() -> None:
            chances = self.model.predict(np.array(vectors, dtype=np.float32)).tolist()
            likely.extend(
                (p, *o) for p, o in zip(chances, offered) if p >= self.thresholds[o[3]]
            )
            offered.clear()
            vectors.clear()

        if self.model:
            for i, (text, base) in enumerate(zip(texts, bases)):
                covered = Covered(base)
                for s, e, kind in candidates(text):
                    if not covered.meets(s, e):
                        offered.append((i, s, e, kind))
                        vectors.append(features(text, s, e, kind))
                        if len(vectors) == SCORED:
                            score()
            if vectors:
                score()
        added: dict[int, list] = {}
        taken: dict[int, Covered] = {}
        for _, i, s, e, kind in sorted(likely, key=lambda x: -x[0]):
            mine = taken.setdefault(i, Covered())
            if not mine.meets(s, e):
                mine.add(s, e)
                added.setdefault(i, []).append((s, e, kind))
        order = {k: i for i, k in enumerate(KINDS)}
        return [
            (base, sorted(base + added.get(i, []), key=lambda x: (x[0], order[x[2]])))
            for i, base in enumerate(bases)
        ]


def _examples(docs: DataFrame, text_col: str) -> DataFrame:
    """All examples: rows (held, n, n_right, matrix) with those of some texts each.

    A row of a matrix has the features, the label and the number of equal ones;
    ``held`` ones set the thresholds.
    """
    ship(docs.sparkSession)

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resident("candidates")
        waiting: dict[bool, list] = {True: [], False: []}

        def out(held: bool) -> pd.DataFrame:
            matrix = np.array(waiting[held], dtype=np.float32)
            waiting[held].clear()
            matrix, copies = np.unique(matrix, axis=0, return_counts=True)
            right = int(copies[matrix[:, -1] == 1].sum())
            # A four-byte float holds any number of copies there can be.
            data = np.column_stack([matrix, copies.astype(np.float32)]).tobytes()
            return pd.DataFrame(
                [(held, int(copies.sum()), right, len(matrix), data)],
                columns=["held", "n", "n_right", "n_rows", "matrix"],
            )

        for batch in batches:
            for held, text in zip(batch["held"], batch["text"]):
                for vector, label in examples(text, base_spans(text)):
                    waiting[held].append([*vector, label])
                    if len(waiting[held]) == MADE:
                        yield out(held)
        for held in waiting:
            if waiting[held]:
                yield out(held)

    text = text_of(text_col)
    held = F.pmod(F.xxhash64(text), F.lit(5)) == 0
    return docs.select(held.alias("held"), text.alias("text")).mapInPandas(
        made, "held boolean, n bigint, n_right bigint, n_rows bigint, matrix binary"
    )


def _matrix(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and copies of a row of examples."""
    matrix = np.frombuffer(data, dtype=np.float32).reshape(-1, FEATURES + 2)
    return matrix[:, :FEATURES], matrix[:, FEATURES], matrix[:, FEATURES + 1].astype(np.int64)


def _cuts(made: DataFrame) -> list[np.ndarray]:
    """The cuts between the bins of each feature: exact quantiles of all examples."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["matrix"]:
                x, _, copies = _matrix(data)
                for i, column in enumerate(x.T):
                    values, which = np.unique(column, return_inverse=True)
                    n = np.bincount(which.ravel(), copies, len(values)).astype(np.int64)
                    yield pd.DataFrame({"feature": i, "value": values.astype(float), "n": n})

    values = made.select("matrix").mapInPandas(counted, "feature int, value double, n bigint")
    at = ", ".join(f"{q!r}D" for q in QUANTILES.tolist())
    found = (
        values.groupBy("feature", "value").agg(F.sum("n").alias("n"))
        .groupBy("feature").agg(F.expr(f"percentile(value, array({at}), n)").alias("cuts"))
        .collect()
    )
    cuts = {r["feature"]: np.unique(np.array(r["cuts"])) for r in found}
    return [cuts[i] for i in range(FEATURES)]


def _thresholds(made: DataFrame, model: Boosted) -> dict[str, float]:
    """The threshold of each kind, from all examples kept back."""

    def stepped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["matrix"]:
                x, y, copies = _matrix(data)
                step = np.floor(model.predict(x) * STEPS).astype(np.int64)
                yield pd.DataFrame(
                    {"kind": x[:, : len(KINDS)].argmax(axis=1), "step": step, "wrong": ((1 - y) * copies).astype(np.int64), "n": copies}
                )

    steps = (
        made.select("matrix").mapInPandas(stepped, "kind int, step bigint, wrong bigint, n bigint")
        .filter(F.col("step") >= STEPS // 2)
        .groupBy("kind", "step").agg(F.sum("wrong").alias("wrong"), F.sum("n").alias("n"))
        .collect()
    )
    thresholds = {}
    for i, kind in enumerate(KINDS):
        mine = sorted(((r["step"], r["wrong"], r["n"]) for r in steps if r["kind"] == i), reverse=True)
        thresholds[kind] = _threshold(mine)
    return thresholds


def fit(docs: DataFrame, text_col: str = "text") -> Redactor:
    """Learn from all examples of the corpus.

    One scan makes the examples and writes them to the shared folder. The bins of
    the features are counted, then each level of a tree is one job whose tasks add
    up the gradients of their examples, and a last job counts the examples kept
    back by their probability. Repeated rows count as often as they stand there.
    """
    made = keep(_examples(docs, text_col), "pii-examples")
    sums = {
        r["held"]: r
        for r in made.groupBy("held").agg(F.sum("n_right").alias("n_right"), F.sum("n_rows").alias("n_rows")).collect()
    }
    if False not in sums or not sums[False]["n_right"]:
        return Redactor(None, dict.fromkeys(KINDS, 2.0))
    train = made.filter(~F.col("held"))
    model = Boosted()
    model.cuts = _cuts(train)

    def binned(rows: Iterator) -> Iterator[tuple]:
        waiting, held = [], 0
        for row in rows:
            waiting.append(_matrix(row["matrix"]))
            held += len(waiting[-1][1])
            if held >= IN_BLOCK:
                yield model.block(*map(np.concatenate, zip(*waiting)))
                waiting, held = [], 0
        if waiting:
            yield model.block(*map(np.concatenate, zip(*waiting)))

    matrices = train.select("matrix").rdd
    parts = min(matrices.getNumPartitions(), -(-sums[False]["n_rows"] // IN_BLOCK))
    blocks = Spread(matrices.coalesce(parts).mapPartitions(binned))
    try:
        model.grow(blocks)
    finally:
        blocks.release()
    return Redactor(model, _thresholds(made.filter("held") if True in sums else train, model))


def _threshold(steps: list[tuple[int, int, int]]) -> float:
    """The lowest probability from which on at most ``MISTAKES`` are wrong; 2 if there is none.

    ``steps`` has the step, the wrong ones and all, from the highest step to the lowest.
    """
    lowest, wrong, n = 2.0, 0, 0
    for step, more_wrong, more in steps:
        wrong, n = wrong + more_wrong, n + more
        if wrong <= MISTAKES * n:
            lowest = step / STEPS
    return lowest


def describe(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: the id, ``base`` and ``spans``, arrays of (start, end, kind)."""
    redactor = fit(docs, text_col)

    def search(texts: list[str]) -> tuple[None, dict]:
        both = redactor.all_spans(texts)

        def rows(spans: list) -> list[dict]:
            return [{"start": s, "end": e, "kind": k} for s, e, k in spans]

        return None, {"base": [rows(b) for b, _ in both], "spans": [rows(a) for _, a in both]}

    span = "array<struct<start:bigint,end:bigint,kind:string>>"
    named = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    found = map_texts(named, search, f"base {span}, spans {span}")
    return found.withColumnRenamed("_id", id_col)


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span replaced by its kind; overlapping spans become one."""
    out, at = [], 0
    i = 0
    while i < len(spans):
        s, e, kind = spans[i]
        while i + 1 < len(spans) and spans[i + 1][0] < e:
            i += 1
            e = max(e, spans[i][1])
        out += [text[at:s], f"[{kind.upper()}]"]
        at = e
        i += 1
    return "".join([*out, text[at:]])


def redact_pii(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The table with personal data replaced; the length follows, nulls stay null."""
    ship(docs.sparkSession)
    redactor = fit(docs, text_col)

    @F.pandas_udf("string")
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        resident("candidates")
        for batch in texts:
            filled = ["" if t is None else t for t in batch]
            spans = [a for _, a in redactor.all_spans(filled)]
            yield pd.Series(
                [None if t is None else redact(t, a) if a else t for t, a in zip(batch, spans)],
                dtype=object,
            )

    text = F.col("_doc")[text_col]
    cleaned = boxed(docs).withColumn("_clean", clean(text))
    columns = []
    for field in docs.schema:
        column = F.col("_doc")[field.name]
        if field.name == text_col:
            column = F.col("_clean")
        elif field.name == length_col:
            same = F.col("_clean").eqNullSafe(text)
            column = F.when(same, column).otherwise(F.length("_clean").cast(field.dataType))
        columns.append(column.alias(field.name))
    return cleaned.select(*columns)
