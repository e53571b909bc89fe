import hashlib
import random

import numpy as np
import pytest
import xxhash
from plain import documents, pairs, union_find
from pyspark.sql import functions as F

from sparkloom.llm import components, exact_dedup, golay, shared, simhash

LONG = "Lorem ipsum dolor " * 6000
ROWS = [
    (1, "Same text", "en"),
    (2, "same TEXT", "en"),
    (3, "other text", None),
    (4, "", "en"),
    (5, None, "en"),
    (6, LONG + "a", "en"),
    (7, LONG + "b", "en"),
    (8, LONG + "A", "en"),
    (9, "ÄB", "de"),
    (10, "äB", "de"),
    (11, "Same texs", "en"),
    (12, "twice", "en"),
    (12, "twice", "en"),
    (13, "split", "en"),
    (13, "other", "en"),
    (None, "split", "en"),
]


def folded(text):
    return (text or "").encode().lower()


def plain_groups(rows):
    groups = {}
    for i, text, _ in rows:
        groups.setdefault(folded(text), []).append(i)
    out, seen = [], set()
    for i, text, _ in rows:
        ids = groups[folded(text)]
        keep = max((x for x in ids if x is not None), default=None)
        first = (folded(text), i) not in seen
        seen.add((folded(text), i))
        out.append(
            (i, keep, len(ids), i == keep and first, hashlib.sha256(folded(text)).hexdigest())
        )
    return sorted(out, key=repr)


def test_exact_groups_equal_plain_ones(spark):
    docs = documents(spark, ROWS, extra=("_sha", "kept", "keep_id", "_bits"))
    found = exact_dedup.exact_groups(docs, all_digests=True)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_groups(ROWS)


def test_full_text_is_hashed_for_surviving_groups_only(spark):
    rows = exact_dedup.exact_groups(documents(spark, ROWS)).collect()
    hashed = {r.doc_id for r in rows if r.full_hash is not None}
    assert 3 not in hashed and 9 not in hashed and {1, 2, 6, 7, 8} <= hashed


def test_exact_copies_are_dropped_and_rows_come_back_whole(spark):
    docs = documents(spark, ROWS, extra=("_sha", "_key", "_piece", "_at"))
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    expected = sorted((r[0] for r in plain_groups(ROWS) if r[3]), key=repr)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == expected


def test_hot_group_of_copies(spark):
    docs = spark.range(30000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "one hot text").otherwise(F.concat(F.lit("t"), "id")).alias("text"),
    )
    groups = exact_dedup.exact_groups(docs)
    hot = groups.filter("group_size > 1").agg(F.count("*"), F.max("keep_id"), F.sum(F.col("kept").cast("int")))
    assert tuple(hot.first()) == (10000, 29997, 1)
    assert exact_dedup.drop_exact_copies(docs).count() == 20001


@pytest.mark.parametrize("work", [exact_dedup.exact_groups, exact_dedup.drop_exact_copies, simhash.near_groups, simhash.drop_near_copies])
def test_empty_tables(spark, work):
    assert work(documents(spark, [])).count() == 0


# SimHash


def plain_fingerprint(text):
    words = [w for w in folded(text).replace(b"\t", b" ").replace(b"\n", b" ").replace(b"\r", b" ").replace(b"\x0b", b" ").replace(b"\x0c", b" ").split(b" ") if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", "  \n", "one", "a b c", "a b c d", "a b c d e", "A B c\x1cd e f g", "ÄÖ ü x\ty\x0bz q", "x " * 500])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_hash_is_sparks(spark):
    value = spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0]
    bits = simhash.fingerprint("A b C d")
    assert bits == value % (1 << 64)


def test_golay_code():
    words = golay.codewords()
    weights = np.bitwise_count(words[1:])
    assert weights.min() == 7 and len(set(words.tolist())) == 4096
    distance = np.bitwise_count(words[golay.decoder()[:: 977]] ^ np.arange(1 << 23)[::977])
    assert distance.max() <= 3


@pytest.mark.parametrize("bits", [21, 22, 23])
def test_words_two_bits_apart_share_a_key(bits):
    rng = np.random.default_rng(bits)
    words = rng.integers(0, 1 << bits, 500)
    for a, b in [(0, 1), (3, bits - 1), (bits - 2, bits - 1), (7, 7)]:
        others = words ^ (1 << a | 1 << b)
        (x, has_x), (y, has_y) = golay.keys(words, bits), golay.keys(others, bits)
        for i in range(len(words)):
            assert set(x[i][has_x[i]]) & set(y[i][has_y[i]])


def test_fingerprints_four_bits_apart_share_a_list():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = int(rng.integers(0, 1 << 63)) * 2 + 1
        b = a
        for bit in rng.choice(64, 4, replace=False):
            b ^= 1 << int(bit)
        keys, at = simhash.list_keys(np.array([a, b], dtype=np.uint64))
        assert set(keys[at == 0]) & set(keys[at == 1])


def near_prints(n, seed):
    """Fingerprints in clusters, chains and alone."""
    r = random.Random(seed)
    prints = set()
    while len(prints) < n:
        p = r.getrandbits(64)
        prints.add(p)
        for _ in range(r.choice([0, 0, 1, 30])):
            for bit in r.sample(range(64), r.choice([1, 2, 3, 4, 5])):
                p ^= 1 << bit
            prints.add(p)
    return sorted(prints)


def test_links_of_one_list_connect_what_is_near():
    prints = near_prints(300, 4)
    expected = union_find(prints, [(a, b) for a, b in pairs(prints) if (a ^ b).bit_count() <= 4])
    array = np.array(prints, dtype=np.uint64)
    for size in (len(prints), 40):
        key = np.zeros(len(prints), np.int32)
        if size == 40:
            array, key = array[:40], key[:40]
            mine = prints[:40]
            expected = union_find(mine, [(a, b) for a, b in pairs(mine) if (a ^ b).bit_count() <= 4])
        found = simhash.linked(key, array)
        assert all((int(a) ^ int(b)).bit_count() <= 4 for a, b in found)
        assert len(found) < len(array)
        assert union_find(expected, [(int(a), int(b)) for a, b in found]) == expected


def test_components_of_fingerprints(spark):
    prints = near_prints(1500, 9)
    expected = union_find(prints, [(a, b) for a, b in pairs(prints) if (a ^ b).bit_count() <= 4])
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    frame = spark.createDataFrame([(signed[p],) for p in prints], "fp bigint")
    links = [(r.a, r.b) for r in simhash.fingerprint_links(frame).collect()]
    back = {v: k for k, v in signed.items()}
    assert union_find(prints, [(back[a], back[b]) for a, b in links]) == expected


def test_the_bitmap_grows_with_the_table(spark):
    assert exact_dedup.bitmap_bits(0) == exact_dedup.BITMAP_LEAST
    assert exact_dedup.bitmap_bits(10**6) == 1 << 24 and exact_dedup.bitmap_bits(10**12) == exact_dedup.BITMAP_MOST
    # A third of the rows are copies; few others go on to the full hash.
    rows = [(i, f"{'copy ' * 80}{i % 1000}" if i % 3 == 0 else f"{'x' * 300}{i * 7919 % 30011:05d} {i}", "en") for i in range(6000)]
    docs = documents(spark, rows).select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    docs = docs.withColumn("_text", F.concat(F.md5("_text").substr(1, 12), "_text"))
    truth = docs.groupBy(F.octet_length("_text"), exact_dedup.prefix_hash(F.col("_text"))).count().filter("count > 1").count()
    refined = exact_dedup.Refined(docs, F.col("_text"))
    assert truth * 2 <= refined.survivors(docs).count() <= 2200
    assert refined.survivors(docs).count() + refined.settled(docs).count() == 6000


@pytest.mark.parametrize("long_list, tile", [(1, 1), (5, 2), (40, 16)])
def test_long_lists_are_compared_in_tiles(spark, long_list, tile):
    # A templated source: two segments shared, so its lists hold all of it.
    r = random.Random(6)
    prints = {0x2AAAA5555533333 | r.getrandbits(21) << 43 for _ in range(60)}
    prints |= set(near_prints(120, 3))
    prints = sorted(p & (2**64 - 1) for p in prints)
    expected = union_find(prints, [(a, b) for a, b in pairs(prints) if (a ^ b).bit_count() <= 4])
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    back = {v: k for k, v in signed.items()}
    frame = spark.createDataFrame([(signed[p],) for p in prints], "fp bigint")
    links = [(back[r.a], back[r.b]) for r in simhash.fingerprint_links(frame, long_list, tile).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in links)
    assert union_find(prints, links) == expected


def test_rows_of_long_lists_are_not_held(monkeypatch):
    import pyarrow as pa

    keys = sorted([1] * 5 + [2] * 5000 + [3] * 40 + [4] * 900 + [5])
    whole = pa.record_batch([pa.array(keys, pa.int32()), pa.array(range(len(keys)))], ["key", "fp"])
    batches = (whole.slice(at, 30) for at in range(0, len(keys), 30))
    parts = list(simhash._lists(batches, 100))
    assert max(len(key) for key, _, _ in parts) <= 2 * 100 + 30
    assert np.concatenate([fp for _, fp, _ in parts]).tolist() == list(range(len(keys)))
    for key, _, is_long in parts:
        assert not is_long or set(key.tolist()) <= {2, 4}
        # What is not passed on as long comes whole or is long by itself.
        assert is_long or all((key == k).sum() == keys.count(k) or (key == k).sum() > 100 for k in set(key.tolist()))


def test_near_groups_equal_plain_ones(spark):
    base = "the quick brown fox jumps over the lazy dog and runs away from all of them today " * 8
    rows = [(i, base + f" end{i}", "en") for i in range(20, 60)]
    rows += [(5, None, "en"), (4, " \n", "en"), (3, "", "en"), (2, "short", "en"), (2, "short", "en"), (1, LONG, "en"), (7, LONG + "z", "en")]
    docs = documents(spark, rows, extra=("fp", "root", "_key"))
    plain = {(i, t): plain_fingerprint(t) for i, t, _ in rows}
    linked = [
        (x, y) for x, y in pairs(sorted(set(plain.values()))) if (x ^ y).bit_count() <= 4
    ]
    part = union_find(sorted(set(plain.values())), linked)
    least = {}
    for (i, t), fp in plain.items():
        least[part[fp]] = min(least.get(part[fp], i), i)
    found = sorted((r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_groups(docs).collect())
    assert found == sorted((i, plain[i, t], least[part[plain[i, t]]]) for i, t, _ in rows)
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_graphs(spark, seed):
    r = random.Random(seed)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(260)]
    edges += [(1000 + i, 1001 + i) for i in range(120)]  # a long path
    edges += [(2000, 2001 + i) for i in range(200)]  # a hub
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    expected = {n: root for n, root in union_find(nodes, [e for e in edges if e[0] != e[1]]).items()}
    assert dict(map(tuple, components.components(frame).collect())) == expected


def test_runs_never_part_a_key():
    import pyarrow as pa

    keys = sorted(random.Random(3).choices(range(30), k=5000))
    batch = pa.record_batch([pa.array(keys)], ["key"])
    parts = list(shared.runs((batch.slice(i, 7) for i in range(0, 5000, 7)), ["key"], rows=50))
    seen = [set(p.column("key").to_pylist()) for p in parts]
    assert sum(p.num_rows for p in parts) == 5000
    assert all(not a & b for a, b in pairs(seen))
