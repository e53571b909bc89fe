import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from plain import documents
from tokenizers import Tokenizer

from sparkloom.llm import packing, queries, sharding, words

PATH = public_tokenizers.path(queries.WORD_TOKENIZER)
WORDS = words.WordTokenizer(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_words_give_the_tokenizers_ids(text):
    assert next(WORDS.texts([text])) == WORDS.whole(text)


@pytest.mark.parametrize(
    "text",
    ["", " ", "Don't STOP 123 a.b", "ΟΔΟΣ Σ", "İstanbul", "é É", "a\x1cb\x1dc", "<|endoftext|> x", "日本 語　x y\u0085z", "a​b", "́x ́"],
)
def test_odd_words_give_the_tokenizers_ids(text):
    assert next(WORDS.texts([text])) == WORDS.whole(text)


def test_words_of_the_tables_are_merged_without_the_tokenizer():
    assert WORDS.merge is not None


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcdest'.,!?-_019 éüßñªº²½\u00ad", max_size=40))
def test_latin_words_give_the_tokenizers_ids(text):
    assert next(WORDS.texts([text])) == WORDS.whole(text)


def test_a_full_memory_of_words_keeps_the_latest(monkeypatch):
    monkeypatch.setattr(words, "CACHE_WORDS", 5)
    own = words.WordTokenizer(PATH)
    texts = [f"word{i} common {'x' * i}" for i in range(20)]
    assert list(own.texts(texts)) == [own.whole(t) for t in texts]
    assert len(own.known) + len(own.known.older) <= 2 * (5 + 3)


def test_a_file_of_another_kind_goes_to_the_tokenizer(tmp_path):
    import json

    file = json.load(open(PATH, encoding="utf-8"))
    file["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = "[a-z]+|[^\\sa-z]"
    other = tmp_path / "other.json"
    other.write_text(json.dumps(file))
    own = words.WordTokenizer(str(other))
    assert own.merge is None
    assert next(own.texts(["a,,b cd1"])) == own.whole("a,,b cd1") != WORDS.whole("a,,b cd1")


def check_layout(rows, capacity):
    """Pieces lie in their sequences without gaps, overlaps or excess."""
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return bins


def test_pieces_and_layout_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.pack(docs, PATH).collect()
    plain = Tokenizer.from_file(PATH)
    expected = []
    for d in docs.collect():
        ids = np.array([*plain.encode(d.text, add_special_tokens=False).ids, 1], dtype="<u4")
        for n, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            expected.append((d.doc_id, n, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(expected)
    bins = check_layout(rows, 4096)
    assert len(bins) <= 1.02 * -(-sum(r.length for r in rows) // 4096) + 1


def test_rounds_merge_the_bins_of_many_parts(spark):
    r = random.Random(1)
    docs = documents(spark, [(i, "word " * r.randrange(1, 99), "en") for i in range(1500)])
    rows = packing.pack(docs, PATH, capacity=128, part_items=20).collect()
    assert len(rows) == 1500
    bins = check_layout(rows, 128)
    alone = len(check_layout(packing.pack(docs, PATH, capacity=128).collect(), 128))
    assert len(bins) <= 1.1 * alone


@pytest.mark.parametrize("short", [0, 30])
def test_rounds_are_bounded_where_pieces_do_not_fit_together(spark, monkeypatch, short):
    r = random.Random(2)
    sizes = [r.randrange(2, 20) for _ in range(short)] + [r.randrange(70, 110) for _ in range(1200)]
    docs = documents(spark, [(i, "word " * n, "en") for i, n in enumerate(sizes)])
    rounds = []

    def counted(items, number, parts, capacity, pack=packing._round):
        rounds.append((items.count(), parts))
        return pack(items, number, parts, capacity)

    monkeypatch.setattr(packing, "_round", counted)
    rows = packing.pack(docs, PATH, capacity=128, part_items=40).collect()
    assert all(items <= parts * 40 for items, parts in rounds)
    assert len(rows) == len(sizes)
    assert len(check_layout(rows, 128)) == 1200


def test_small_bins_meet_the_roomiest_ones(spark):
    fills = [*[10] * 3, *[64] * 2, *[70] * 4, *[71] * 5000, *[100] * 50, *[119] * 20, 127]
    rows = [(i, i, 0, f) for i, f in enumerate(fills)] + [(-1, 0, 1, 10)]
    packed = spark.createDataFrame(rows, "item bigint, bin bigint, offset bigint, fill bigint")
    left = sorted(r.length for r in packing._open(packed, 126, 128).collect())
    assert left[:9] == [10] * 3 + [64] * 2 + [70] * 4 and set(left[9:]) <= {71} and len(left) < 60
    alone = packed.filter("fill > 64")
    assert packing._open(alone, 126, 128).count() == 0


def test_best_fit_equals_plain_one():
    r = random.Random(5)
    lengths = [r.randrange(1, 60) for _ in range(500)]
    bins, offsets, fills = packing.best_fit(lengths, 100)
    rooms = []
    for length, b, offset in zip(lengths, bins, offsets):
        fitting = [room for room in rooms if room >= length]
        if b == len(rooms):
            assert not fitting
            rooms.append(100)
        else:
            assert rooms[b] == min(fitting)
        assert offset == 100 - rooms[b]
        rooms[b] -= length
    assert fills == [100 - x for x in rooms]


def test_packing_of_odd_rows(spark):
    rows = [(1, None, None), (2, "", "en"), (2, "", "en"), (3, "word " * 9000, "en"), (None, "x", "en"), (2**60 + 1, "y", "en"), (4, "word " * 4095, "en")]
    docs = documents(spark, rows, ("item", "piece", "bin", "offset", "_text", "_id"))
    found = packing.pack(docs, PATH).collect()
    check_layout(found, 4096)
    sizes = {}
    for r in found:
        sizes.setdefault(r.doc_id, []).append(r.length)
    assert sizes[1] == [1] and sizes[2] == [1, 1] and sorted(sizes[3]) == [809, 4096, 4096]
    assert sizes[4] == [4096] and sizes[None] == [2] and sizes[2**60 + 1] == [2]
    assert packing.pack(documents(spark, []), PATH).count() == 0


# Sharding

NAMES = [f"s{i}" for i in range(12)]


def plain_table(shards, slots):
    """Turn by turn, each shard's first free slot in its own order."""
    orders = []
    for s in shards:
        start, step = sharding.preference(s, slots)
        orders.append([(start + j * step) % slots for j in range(slots)])
    owner = {}
    turn = 0
    while len(owner) < slots:
        mine = next(x for x in orders[turn % len(shards)] if x not in owner)
        owner[mine] = turn % len(shards)
        turn += 1
    return [owner[i] for i in range(slots)]


@pytest.mark.parametrize("slots", [13, 101, 499])
def test_table_equals_plain_one(slots):
    assert sharding.fill_table(NAMES, slots) == plain_table(NAMES, slots)


def test_table_is_even_and_stable():
    before = sharding.fill_table(NAMES, 8191)
    counts = np.bincount(before)
    assert counts.max() - counts.min() <= 1
    after = sharding.fill_table(NAMES[:-1], 8191)
    moved = sum(a != b for a, b in zip(before, after) if b is not None and a != 11)
    assert moved < 0.1 * 8191


def test_tables_that_cannot_be():
    for shards, slots in (([], 13), (["a", "a"], 13), (["a", "b"], 12), (NAMES, 11)):
        with pytest.raises(ValueError):
            sharding.fill_table(shards, slots)


def test_placement_of_odd_rows(spark):
    docs = documents(spark, [(1, "a", None), (1, "a", None), (None, "b", "x"), (2, None, None)], ("slot", "shard"))
    rows = sharding.place(docs, "doc_id", NAMES, 101).collect()
    table = sharding.fill_table(NAMES, 101)
    for r in rows:
        slot = sharding.hash60("" if r.doc_id is None else str(r.doc_id)) % 101
        assert (r.slot, r.shard) == (slot, NAMES[table[slot]])
    assert len(rows) == 4 and rows[0].shard == rows[1].shard
    assert sharding.place(docs.limit(0), "doc_id", NAMES, 101).count() == 0


def test_placement_does_not_shuffle(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plan = sharding.place(docs, "doc_id", NAMES)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert not any(word in plan for word in ("Python", "Pandas", "ArrowEval"))
