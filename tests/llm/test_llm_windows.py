import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from plain import documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkloom.llm import queries, windows

PATH = public_tokenizers.path(queries.WORD_TOKENIZER)
PLAIN = Tokenizer.from_file(PATH)


def padding(length, capacity):
    return 0 if length & (length - 1) == 0 else capacity - length


def cost_of(cuts, ends, costs, capacity):
    total, before = 0, 0
    for c in cuts:
        total += padding(int(ends[c]) - before, capacity) + int(costs[c])
        before = int(ends[c])
    return total


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.tuples(st.integers(1, 20), st.sampled_from([0, 3, 9])), min_size=1, max_size=60),
    st.sampled_from([20, 32, 50]),
)
def test_cuts_cost_as_little_as_plain_dynamic_programming(steps, capacity):
    ends = np.concatenate([[0], np.cumsum([s for s, _ in steps])])
    costs = np.array([0, *[c for _, c in steps]])
    least = [0]
    for i in range(1, len(ends)):
        least.append(
            costs[i]
            + min(
                least[j] + padding(int(ends[i] - ends[j]), capacity)
                for j in range(i)
                if ends[i] - ends[j] <= capacity
            )
        )
    cuts = windows.best_cuts(ends, costs, capacity)
    assert cuts[-1] == len(ends) - 1 and all(a < b for a, b in zip([0, *cuts], cuts))
    assert np.diff(np.concatenate([[0], ends[cuts]])).max() <= capacity
    assert cost_of(cuts, ends, costs, capacity) == least[-1]


def test_long_stretches_get_places():
    ends, costs = windows.places(np.array([3, 40]), np.array([1, 0]), 45, 10, 99)
    assert ends.tolist() == [0, 3, 13, 23, 33, 40, 45]
    assert costs.tolist() == [0, 1, 99, 99, 99, 0, 0]
    ends, costs = windows.places(np.array([], int), np.array([], int), 5, 10, 99)
    assert ends.tolist() == [0, 5]


def ids_of(text, end=2):
    return np.array([*PLAIN.encode(text or "", add_special_tokens=False).ids, end], dtype="<u4")


def check(rows, texts, capacity):
    """Each id in one piece, sequences without gaps; gives the sequences' lengths."""
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == set(texts)
    for doc, text in texts.items():
        ids, at = ids_of(text), 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    sizes = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        sizes.append(at)
    return sizes


def test_whole_table_in_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = queries.QUERIES["op12_order_preserving_packing"](spark, "/root/testdata/sf0.01").collect()
    sizes = check(rows, {r.doc_id: r.text for r in docs.collect()}, 4096)
    assert sum(padding(n, 4096) for n in sizes) < 0.01 * sum(sizes)
    cut = len(rows) - docs.count()
    assert cut <= len(sizes)


@pytest.mark.parametrize("block", [1, 400])
def test_small_blocks_long_and_empty_texts(spark, block):
    r = random.Random(3)
    words = ["one", "two.", "three", "four!", "five"]
    texts = {i: " ".join(r.choices(words, k=r.randrange(0, 90))) for i in range(120)}
    texts |= {200: None, 201: "", 202: "word " * 2000, 203: "end. " * 900}
    docs = documents(spark, [(i, t, "en") for i, t in texts.items()], extra=("_id", "_text", "start", "length"))
    rows = windows.pack_windows(docs.repartition(3), PATH, capacity=64, block=block, stretch=16).collect()
    sizes = check(rows, texts, 64)
    # Three tasks, each with one window that takes what is left.
    assert sum(padding(n, 64) for n in sizes) < 0.05 * sum(sizes)


def test_sequences_follow_the_order_asked_for(spark):
    docs = documents(spark, [(i, f"document {i} is here.", "en") for i in range(300)])
    shuffled = docs.repartition(7).withColumn("rank", -F.col("doc_id"))
    rows = windows.pack_windows(shuffled, PATH, capacity=64, order=["rank"]).collect()
    rows.sort(key=lambda r: (r.sequence_id, r.offset))
    assert [r.doc_id for r in rows if r.start == 0] == sorted(range(300), reverse=True)


def test_cuts_prefer_ends_of_sentences(spark):
    text = ("seven words stand in this sentence here. " * 40).strip()
    rows = windows.pack_windows(documents(spark, [(1, text, "en")]), PATH, capacity=64).collect()
    period = ids_of("here.")[-2]
    ids = ids_of(text)
    for r in rows:
        stop = r.start + r.length
        assert stop == len(ids) or ids[stop - 1] == period


def test_repeated_rows_and_empty_tables(spark):
    docs = documents(spark, [(5, "same text.", "en")] * 4)
    rows = windows.pack_windows(docs, PATH).collect()
    assert sum(r.length for r in rows if r.start == 0) == 4 * len(ids_of("same text."))
    empty = windows.pack_windows(documents(spark, []), PATH)
    assert empty.count() == 0 and empty.columns == [
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    ]
