import itertools
import random
import re
import time

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from plain import documents
from pyspark.sql import functions as F

from sparkloom.llm import boosting, language, nbest, pages, pii, queries, quality

SF = "/root/testdata/sf0.1"
ODD = [
    (1, None, None),
    (2, "", "en"),
    (3, " \n\t ", "en"),
    (4, "1234 !!! 5678", "en"),
    (5, "word " * 30000, "en"),
    (6, "The same words again and again", "en"),
    (6, "The same words again and again", "en"),
    (None, "no id at all", None),
    (2**60 + 1, "large id", "de"),
]
CLASHING = ("score", "x", "_text", "_id", "label", "predicted", "base", "_clean", "_doc")

# Quality


def test_statistics_of_odd_texts():
    for _, text, _ in ODD:
        values = quality.statistics(text or "")
        assert len(values) == len(quality.FEATURES) and np.isfinite(values).all()
    assert quality.statistics("") == quality.statistics(" \n") == [0.0] * len(quality.FEATURES)


def test_moments_and_discriminant_equal_plain_ones(spark):
    rng = np.random.default_rng(5)
    d = len(quality.FEATURES)
    x = rng.standard_normal((600, d))
    y = (rng.random(600) < 0.7).astype(int)
    x[y == 1] = x[y == 1] @ rng.standard_normal((d, d)) * 0.3 + 1
    rows = spark.createDataFrame(
        [(int(label), v.tolist()) for label, v in zip(y, x)], "label int, x array<double>"
    )
    moments = quality._moments(rows.repartition(5))
    model = quality.Discriminant(moments)
    plain = []
    pooled = sum(np.cov(x[y == c].T, bias=True) * (y == c).sum() for c in (0, 1)) / len(y)
    scale = np.sqrt(np.diag(pooled))
    for c in (0, 1):
        own = 0.8 * np.cov(x[y == c].T, bias=True) + 0.2 * pooled
        own /= np.outer(scale, scale)
        own = 0.98 * own + 0.02 * (np.trace(own) / d + 1e-6) * np.eye(d)
        z = (x - x[y == c].mean(axis=0)) / scale
        distance = (z @ np.linalg.inv(own) * z).sum(axis=1)
        plain.append(-0.5 * distance - 0.5 * np.linalg.slogdet(own)[1] + np.log((y == c).mean()))
    assert np.allclose(model.margin(x), (plain[1] - plain[0]) / np.sqrt(d))


def test_quality_on_held_out_rows(spark):
    scored = queries.QUERIES["op1_quality_classifier"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = scored.filter("held_out").join(labels, "doc_id").select("predicted", "quality", "score").toPandas()
    assert len(rows) > 500 and rows.score.between(0, 1).all()
    assert (rows.predicted == rows.quality).mean() > 0.97
    assert rows[rows.quality == 1].predicted.mean() > 0.985


def test_quality_of_odd_rows(spark):
    docs = documents(spark, ODD, CLASHING)
    labels = spark.createDataFrame(
        [(i, q, None) for i, q in [(4, 0), (5, 0), (6, 1), (2, 1), (3, 1), (1, None), (1, 7)]],
        "doc_id bigint, quality int, toxic int",
    )
    rows = quality.score_quality(docs, labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    by_id = {r.doc_id: r.score for r in rows}
    assert by_id[1] == by_id[2] == by_id[3]
    kept = quality.drop_low_quality(docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() == len(ODD)
    assert quality.score_quality(documents(spark, []), labels).count() == 0


# Language


def plain_phrases(symbols, sample):
    text = bytes(sample)
    count, at = 0, 0
    while at < len(symbols):
        end = at + 1
        while end < len(symbols) and bytes(symbols[at : end + 1]) in text:
            end += 1
        count += 1
        at = end
    return count


def test_phrases_equal_plain_ones():
    r = random.Random(2)
    samples = {n: "".join(r.choice(s) for _ in range(700)) for n, s in (("a", "abc "), ("b", "bcdx "))}
    parser = language.Parser(samples)
    texts = ["".join(r.choice("abcdxq ") for _ in range(r.randrange(1, 300))) for _ in range(40)]
    coded = [parser.alphabet.symbols(language.letters(t)) for t in texts]
    found = parser.phrases(coded)
    for name, column in zip(parser.names, found.T):
        sample = parser.alphabet.symbols(language.letters(samples[name])).tolist()
        assert column.tolist() == [plain_phrases(c.tolist(), sample) if len(c) else 0 for c in coded]


@pytest.mark.parametrize("block", [1, 2, 7, 64])
def test_phrases_do_not_depend_on_the_block(monkeypatch, block):
    r = random.Random(7)
    samples = {n: "".join(r.choice(s) for _ in range(900)) for n, s in (("a", "ab "), ("b", "bcd"), ("c", "日本語x"))}
    samples["d"] = "abcdefgh ijkl " * 40
    parser = language.Parser(samples)
    texts = ["".join(r.choice("abcd日本 ") for _ in range(r.randrange(0, 400))) for _ in range(30)]
    # Phrases much longer than a block: the parses from its start never meet.
    texts += [samples["d"], samples["d"][5:] + "zz" + samples["a"], samples["c"][3:500]]
    coded = [parser.alphabet.symbols(language.letters(t)) for t in texts]
    whole = parser.phrases(coded)
    monkeypatch.setattr(language, "BLOCK", block)
    assert (parser.phrases(coded) == whole).all()
    sample = language.letters(samples["d"])[: language.SAMPLE_SYMBOLS]
    assert whole[30][parser.names.index("d")] == 1 and len(sample)


def test_languages_of_one_script_are_told_apart():
    r = random.Random(5)
    stock = [chr(0x4E00 + i) for i in range(3000)]
    r.shuffle(stock)
    words = {
        n: ["".join(r.choices(stock[at : at + 2000], k=r.randrange(1, 4))) for _ in range(400)]
        for n, at in (("one", 0), ("two", 1000))
    }
    parser = language.Parser({n: " ".join(r.choices(w, k=3000)) for n, w in words.items()})
    texts = [(n, " ".join(r.choices(w, k=30))) for n, w in words.items() for _ in range(50)]
    assert [a for a, _ in parser.classify([t for _, t in texts])] == [n for n, _ in texts]
    # Letters are not confused with others of their code block.
    known = language.Parser({"one": "日本語 の文"}).alphabet
    symbols = known.symbols(language.letters("日本語中")).tolist()
    assert len(set(symbols)) == 4 and symbols[3] == known.size


def test_a_long_first_row_leaves_room_for_the_others():
    long, short = "a" * 100_000, "quick brown fox"
    text = language._shared_out([long, short, "", "12", "lazy dog " * 9], 1000)
    assert short in text and "lazy dog " * 8 in text and len(text) <= 1000 + 2
    assert text.count("a") > 800
    assert language._shared_out([], 1000) == "" and language._shared_out(["abc"] * 5, 10) == "ab ab ab ab ab"


def test_long_texts_are_parsed_whole():
    parser = language.Parser({"a": "abab abba " * 20, "b": "xyxy yxxy " * 20})
    head = "abab " * 400
    assert parser.classify([head + "xyxy yxxy " * 2000])[0][0] == "b"
    assert parser.classify([head])[0][0] == "a"


def test_language_of_held_out_rows(spark):
    found = queries.QUERIES["op9_language_id"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = found.filter("held_out").join(docs, "doc_id").toPandas()
    assert len(rows) > 2000 and (rows.lang_pred == rows.lang).mean() > 0.97


def test_language_of_odd_rows(spark):
    teach = [(100 + i, "the quick brown fox", "en") for i in range(8)]
    teach += [(200 + i, "der schnelle braune fuchs", "de") for i in range(8)]
    rows = language.identify(documents(spark, ODD + teach, CLASHING)).collect()
    assert len(rows) == len(ODD) + 16
    by_id = {r.doc_id: r.lang_pred for r in rows}
    assert by_id[1] == by_id[2] == by_id[3] == by_id[4] == "und"
    assert by_id[2**60 + 1] in ("en", "de") and by_id[200] == "de"
    assert language.identify(documents(spark, [])).count() == 0
    untaught = language.identify(documents(spark, [(1, "some text", None)])).first()
    assert (untaught.lang_pred, untaught.score) == ("und", 0.0)


# Personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    found = [(m.start(), m.end(), 0) for m in EMAIL.finditer(text)]
    found += [(m.start(), m.end(), 1) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = [int(c) for c in m[0] if c.isdigit()][::-1]
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits))
        if 12 <= len(digits) <= 19 and total % 10 == 0:
            found.append((m.start(), m.end(), 2))
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((m.start(), m.end(), 3))
    return [(s, e, pii.KINDS[k]) for s, e, k in sorted(found, key=lambda x: (x[0], x[2]))]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a.@-1025+ ()_é\n", max_size=60))
def test_base_spans_equal_plain_ones(text):
    assert pii.base_spans(text) == plain_spans(text)


@pytest.mark.parametrize(
    "text",
    [
        "a@b.c_d@e.f@g.h", "1.2.3.4.5.6.7.8.9", "001.0002.255.0255 0.0.0.256", "4111 1111-1111 1111 0",
        "+1 (555) 010-9999 +49.. 30 +1 2", "4111111111111111", "x@y x@y.z. .@a.b", "1..2.3.4.5",
    ],
)
def test_base_spans_of_edges(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_base_spans_equal_plain_ones_on_documents(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    assert all(pii.base_spans(t) == plain_spans(t) for t in texts)
    assert sum(len(plain_spans(t)) for t in texts) > 20


@pytest.mark.parametrize("unit", ["a", "1", "1.", "+", "a@", "@", "+1 ", " at ", "1 "])
def test_spans_take_linear_time(unit):
    text = unit * (200_000 // len(unit))
    pii.base_spans(text)
    pii.candidates(text)


def test_covered_stretches():
    r = random.Random(4)
    spans = [(a, a + r.randrange(1, 9), "x") for a in r.choices(range(200), k=25)]
    covered = pii.Covered(spans)
    for s in range(210):
        for e in (s + 1, s + 7):
            assert covered.meets(s, e) == any(s < be and e > bs for bs, be, _ in spans)


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    model = boosting.Boosted(trees=80).fit(x[:2000], y[:2000])
    assert ((model.predict(x[2000:]) > 0.5) == y[2000:]).mean() > 0.97


def test_trees_of_spread_examples_equal_local_ones(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 9, (4000, 5)).astype(np.float32)
    y = ((x[:, 0] > 4) ^ (x[:, 2] > 3) ^ (rng.random(4000) < 0.1)).astype(np.float32)
    local = boosting.Boosted(trees=15).fit(x, y)
    model = boosting.Boosted(trees=15)
    model.cuts = local.cuts
    parts = [model.block(x[i::7], y[i::7], np.ones(len(y[i::7]), np.int64)) for i in range(7)]
    blocks = boosting.Spread(spark.sparkContext.parallelize(parts, 5))
    model.grow(blocks)
    blocks.release()
    assert len(model.forest) == 15 and (model.predict(x) == local.predict(x)).all()


def test_trees_learn_from_every_span_of_a_text(spark):
    # Telephone numbers only behind ten other spans and thousands of characters, and
    # more candidates in one text than a share of them would show.
    head = " ".join(f"write to user{i}.name@mail{i}.example.com or not," for i in range(12))
    texts = [
        f"{head} {'filler words ' * 400} call +1 (626) 555-{1000 + 7 * n} today, item 12 or {n}"
        for n in range(60)
    ]
    redactor = pii.fit(documents(spark, [(n, t, "en") for n, t in enumerate(texts)]))
    assert redactor.thresholds["phone"] <= 1
    made = pii._examples(documents(spark, [(1, "12345678 " * 200, "en")]), "text")
    plain = len(pii.candidates("12345678 " * 200))
    assert made.agg(F.sum("n")).collect()[0][0] == plain > 64


@pytest.fixture(scope="module")
def redactor(spark):
    return pii.fit(spark.read.parquet(f"{SF}/documents.parquet"))


@pytest.mark.parametrize(
    "text, span",
    [
        ("and hand over to john.smith [at] mail3.example.com then", "john.smith [at] mail3.example.com"),
        ("reach erin.42 at mail1 dot example dot com now", "erin.42 at mail1 dot example dot com"),
        ("then (626) 555-5759 again", "(626) 555-5759"),
    ],
)
def test_looser_forms_are_found(redactor, text, span):
    at = text.index(span)
    assert any(s <= at and e >= at + len(span) for s, e, _ in redactor.spans(text))


@pytest.mark.parametrize("text", ["on 2024-01-15 and 12/03/2019", "version 10.4.2 of 1999-2008", "look at this. Com", "they met at noon at the inn"])
def test_look_alikes_are_left(redactor, text):
    assert redactor.spans(text) == []


def test_base_spans_stay_and_added_ones_are_few(spark, redactor):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(3000).collect()]
    both = redactor.all_spans(texts)
    assert all(set(base) <= set(spans) for base, spans in both)
    base, every = sum(len(b) for b, _ in both), sum(len(s) for _, s in both)
    assert every - base <= 0.02 * base


def test_pii_of_odd_rows(spark):
    rows = ODD + [(50, "mail a.b@c.de, +1 (555) 010-9999 and 10.0.0.1", "en")]
    docs = documents(spark, rows, CLASHING)
    found = {r.doc_id: r for r in pii.find_pii(docs).collect()}
    assert [s.kind for s in found[50].base] == ["email", "phone", "ip"] and found[1].spans == []
    clean = pii.redact_pii(docs)
    assert clean.columns == docs.columns and clean.schema["n_chars"] == docs.schema["n_chars"]
    out = {r.doc_id: r for r in clean.collect()}
    assert out[50].text == "mail [EMAIL], [PHONE] and [IP]" and out[50].n_chars == len(out[50].text)
    assert out[1].text is None and out[2**60 + 1].text == "large id"
    assert pii.find_pii(documents(spark, [])).count() == 0
    assert pii.redact_pii(documents(spark, [])).count() == 0


LISTS = [
    ("call 555-123-4567, 555-987-6543 now", ["555-123-4567", "555-987-6543"]),
    ("born 1980-05-12, 555-123-4567 is the phone", ["555-123-4567"]),
    ("room 12 555-123-4567 all day", ["555-123-4567"]),
    ("call +1 626 555 5759, 555-123-4567 now", ["555-123-4567"]),
    ("call (626) 555-5759, (626) 555-1234, (626) 555-0101 now", ["(626) 555-5759", "(626) 555-1234", "(626) 555-0101"]),
]


@pytest.mark.parametrize("text, spans", LISTS)
def test_numbers_beside_others_are_proposed(text, spans):
    proposed = {text[s:e] for s, e, kind in pii.candidates(text) if kind == "phone"}
    assert proposed >= set(spans)


@pytest.mark.parametrize("text, spans", LISTS)
def test_numbers_beside_others_are_found(redactor, text, spans):
    (base, found), = redactor.all_spans([text])
    assert [text[s:e] for s, e, k in found if k == "phone" and (s, e, k) not in base] == spans


def test_proposals_of_a_long_stretch_are_bounded_and_scored_in_slices(redactor, monkeypatch):
    text = "1 " * 3000
    assert len(pii.candidates(text)) <= 20 * 3000
    assert {"10[.]0[.]0[.]1", "john [at] a.com"} <= {
        t[s:e] for t in ("5-10[.]0[.]0[.]1", "john [at] a.com.Then") for s, e, _ in pii.candidates(t)
    }
    texts = [t for t, _ in LISTS]
    whole = redactor.all_spans(texts)
    monkeypatch.setattr(pii, "SCORED", 3)
    assert redactor.all_spans(texts) == whole


def test_long_names_and_hosts_are_proposed_whole():
    name, host = "n" * 300, " dot ".join(["mail", "a", "b", "c", "d", "e", "com"])
    label = "x" * 100
    text = f"to {name} at {host} and jane [at] {label}.org, kim at h dot com"
    proposed = {text[s:e] for s, e, kind in pii.candidates(text) if kind == "email"}
    assert {f"{name} at {host}", f"jane [at] {label}.org", "kim at h dot com"} <= proposed
    assert f"{name} at mail dot a" in proposed


def test_hosts_that_share_their_ends_take_linear_time():
    text = "a at b" + " dot at dot b" * 20_000
    start = time.process_time()
    found = pii.candidates(text)
    assert time.process_time() - start < 10 and len(found) <= 8 * 20_000
    assert (0, len(text), "email") in found


def test_redaction_joins_overlapping_spans():
    assert pii.redact("ab1234567cd", [(2, 6, "card"), (4, 9, "phone")]) == "ab[CARD]cd"


# Pages


def test_regions_of_a_page():
    page = (
        "<html><head><title>t</title><style>p{}</style></head><body class='has-sidebar'>"
        "<header>Top</header><nav><a>Menu</a></nav><!-- <p>no</p> -->"
        "<article class='post'><h1>Head</h1><p>One &amp; <b>two</b>!<p>Three<script>var x='</p>'</script>"
        "<div class='post-comments'><p>Reader says</p></div><form>f</form><footer>by me</footer></article>"
        "<div id=cookie-notice>ok?</div><aside>side</aside><p hidden>h</p><p>loose</p></body>"
    )
    assert pages.main_text(page) == "Head One & two! Three"
    regions = {text: region for region, text in pages.blocks(page)}
    assert regions["Top"] == regions["Menu"] == regions["ok?"] == regions["side"] == "out"
    assert regions["loose"] == "open" and "no" not in regions


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article>a<br>b&nbsp;c</article>", "a b c"),
        ("<main>x<article>y</article></main>", "x y"),
        ("<article>own</article><article class='comment'>theirs</article>", "own"),
        (f"<article><p data-x='{'>' * 9000}leak'>a</p>b</article>", "a b"),
        ("<article><p title='no end>a</p>b</article>", "a b"),
        ("<article>a <b title=it's>b</b> c's</article>", "a b c's"),
        ("<main>x<p>y</main>z", "x y"),
        ("<article><p>cut &am", "cut &am"),
        ("<article><p>cut</p><p cla", "cut"),
        ("<article>1 < 2 and 3 > 2</article>", "1 < 2 and 3 > 2"),
        ("<ARTICLE><P>up</P></ARTICLE>", "up"),
        ('<article><a href="x>y">q</a></article>', "q"),
        ("<article><p>a</div>b</p></article>", "a b"),
        ("<article>a<i>b</i>c</article>", "abc"),
        ("<div role='main'>r</div>", "r"),
        ("<article></article>", ""),
    ],
)
def test_articles(page, text):
    assert pages.main_text(page) == text


def test_articles_of_the_test_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    for r in rows:
        inner = re.search(r"<article>(.*?)(?:</article>|$)", r.html, re.S)[1]
        import html

        plain = " ".join(html.unescape(re.sub(r"</?(?:p|br|h1)>", " ", re.sub(r"</?b>", "", inner))).split())
        assert pages.main_text(r.html) == re.sub(r" ?<[^>]*$", "", plain)


def body(*parts):
    return "<body>" + "".join(f"<p>{p}</p>" for p in parts) + "</body>"


SAME = "all rights reserved by the owners of this fine site and of its parts"
MORE = "click here to read more of our best stories of this whole long week"


def test_repeats_within_a_host_are_removed(spark):
    rows = [
        (1, "http://a.org/1", body(MORE, "alpha beta gamma", SAME)),
        (2, "http://A.org:80/2", body(MORE, "delta epsilon zeta", SAME)),
        (3, "http://b.org/1", body(MORE, "eta theta iota", SAME)),
        (4, "http://a.org/4", body("quoted " + MORE)),
        (5, "http://a.org/1?x", body(MORE, "alpha beta gamma", SAME)),
        (6, None, None),
        (7, "http://a.org/7", ""),
        (8, "http://a.org/8", "<article>" + SAME + "</article>"),
        (8, "http://a.org/8", "<article>" + SAME + "</article>"),
        (None, "http://c.org", "<p>tiny"),
        (2**60 + 1, "http://c.org", "<article>big</article>"),
    ]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns(
        {c: F.lit(None).cast("string") for c in ("text", "words", "row", "_host", "starts")}
    )
    found = pages.extract_text(table)
    out = sorted(((r.page_id, r.text) for r in found.collect()), key=repr)
    assert out == sorted(
        [
            (1, "alpha beta gamma"), (2, "delta epsilon zeta"), (3, f"{MORE} eta theta iota {SAME}"),
            (4, "quoted"), (5, "alpha beta gamma"), (6, ""), (7, ""), (8, SAME), (8, SAME),
            (None, "tiny"), (2**60 + 1, "big"),
        ],
        key=repr,
    )
    assert pages.extract_text(table.limit(0)).count() == 0


def extracted(spark, rows):
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return {r.page_id: r.text for r in pages.extract_text(table).collect()}


def test_what_the_markup_leaves_open_is_kept_unless_it_repeats(spark):
    card = "<article>teaser of another story</article>"
    lead = "<div id='story'><p>The real lead.</p><p>And the body.</p></div>"
    again = f"<div class='post-footer'>{SAME}</div>"
    found = extracted(
        spark,
        [
            (1, "http://a/1", card + lead),
            (2, "http://a/2", "<main><p>Lead</p><article>Inner</article></main>"),
            (3, "http://a/3", "<article><div class='post-header'><h1>Title</h1></div>Text"
                              "<section class='related-work'>Others did this.</section></article>"),
            (4, "http://a/4", f"<article>One text{again}</article>"),
            (5, "http://a/5", f"<article>Other text{again}</article><p>loose end</p>"),
            (6, "http://b/6", f"<article>One text{again}</article>"),
            (7, "http://a/7", f"<article>{SAME}</article>"),
            (8, "http://a/8", "<article>Mine<div class='post-comments'>theirs</div></article>"),
        ],
    )
    assert found == {
        1: "teaser of another story The real lead. And the body.", 2: "Lead Inner",
        3: "Title Text Others did this.", 4: "One text", 5: "Other text loose end", 6: f"One text {SAME}",
        7: SAME, 8: "Mine",
    }


def test_only_the_repeats_can_tell(spark):
    """Pages without any name for their parts: what repeats on the host goes."""
    r = random.Random(4)
    menu = " ".join(f"entry{i}" for i in range(12))
    stories = [" ".join(f"w{r.randrange(10**6)}" for _ in range(r.randrange(3, 60))) for _ in range(40)]
    rows = [
        (i, "http://same.host/" + str(i), f"<body><div>{menu}</div><div><p>{story}</p></div><div>{SAME}</div>")
        for i, story in enumerate(stories)
    ]
    assert extracted(spark, rows) == dict(enumerate(stories))


@pytest.mark.parametrize("unit", ["<p a='", "<", "<a ", "<p a=\"x\" b='y' ", "<!--", "</", "<p>'", "=\""])
def test_markup_is_read_in_linear_time(unit):
    start = time.process_time()
    pages.blocks(unit * 60_000)
    assert time.process_time() - start < 5


def plain_unique(streams, repeat):
    """Uncovered tokens of each stream of one host."""
    where = {}
    for words in set(map(tuple, streams)):
        for at in range(max(1, len(words) - repeat + 1)):
            where.setdefault(words[at : at + repeat], set()).add(words)
    out = []
    for words in map(tuple, streams):
        covered = set()
        for at in range(max(1, len(words) - repeat + 1)):
            if len(where[words[at : at + repeat]]) > 1:
                covered.update(range(at, at + repeat))
        out.append(" ".join(w for i, w in enumerate(words) if i not in covered))
    return out


def test_repeats_equal_plain_ones(spark):
    r = random.Random(8)
    stock = [" ".join(r.choice("abcdefgh") * 2 for _ in range(r.randrange(5, 14))) for _ in range(6)]
    streams = []
    for _ in range(60):
        own = [" ".join(str(r.random()) for _ in range(r.randrange(1, 6))) for _ in range(3)]
        streams.append(" ".join(itertools.chain(*zip(r.sample(stock, 3), own))).split())
    rows = [(i, "http://h/", body(*[" ".join(s)])) for i, s in enumerate(streams)]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {row.page_id: row.text for row in pages.extract_text(table, repeat=6).collect()}
    assert [found[i] for i in range(60)] == plain_unique(streams, 6)


# N-best segmentation

MODEL = public_tokenizers.path(queries.PIECE_MODEL)


@pytest.fixture(scope="module")
def segmenter():
    return nbest.Segmenter(MODEL, best=4)


def all_paths(segmenter, text):
    out = []

    def go(at, score, ids):
        if at == len(text):
            out.append((score, ids))
            return
        for end in range(at + 1, len(text) + 1):
            i = segmenter.ids.get(text[at:end])
            if i is not None:
                go(end, score + segmenter.scores[i], (*ids, i))
        if text[at] not in segmenter.ids:
            go(at + 1, score + segmenter.unknown, ids + segmenter.raw(text[at]))

    go(0, 0.0, ())
    return sorted(out, key=lambda p: -p[0])


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="atheingo .▁\n日é", max_size=9))
def test_best_segmentations_equal_plain_ones(text):
    own = test_best_segmentations_equal_plain_ones.segmenter
    plain = all_paths(own, own.model.normalize(text)) if text else [(0.0, ())]
    found = own.nbest(text)
    assert [s for s, _ in found] == [s for s, _ in plain[:4]]
    ids = [tuple(np.frombuffer(i, "<u4").tolist()) for _, i in found]
    assert len(set(ids)) == len(ids) and set(ids) <= {i for _, i in plain}


test_best_segmentations_equal_plain_ones.segmenter = nbest.Segmenter(MODEL, best=4)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_decoding_gives_the_text_back(text):
    own = test_best_segmentations_equal_plain_ones.segmenter
    text = text.replace("\x00", "")
    for _, ids in own.nbest(text):
        assert own.decode(np.frombuffer(ids, "<u4").tolist()) == own.model.normalize(text).replace("▁", " ")[1:]


def test_encode_and_decode_of_odd_rows(spark):
    docs = documents(spark, ODD, CLASHING)
    encoded = nbest.encode(docs, MODEL, best=3)
    first = encoded.filter("rank = 1")
    assert first.count() == len(ODD)
    texts = {r.doc_id: r.text for r in nbest.decode(first, MODEL).collect()}
    assert texts == {i: t or "" for i, t, _ in ODD}
    assert encoded.filter("doc_id = 2").count() == 1
    scores = encoded.toPandas().sort_values("rank").groupby("doc_id").score
    assert all(s.is_monotonic_decreasing for _, s in scores)
    assert nbest.encode(documents(spark, []), MODEL).count() == 0


def test_digests_agree_with_the_ids(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = nbest.encode(docs, MODEL, digests=True).toPandas()
    assert rows.round_trip.all() and len(rows) >= 3 * docs.count() - 3
    import zlib

    crcs = rows.ids.map(lambda i: zlib.crc32(np.array(i, dtype="<i4").tobytes()))
    assert (rows.ids_crc32 == crcs).all() and (rows.n_pieces == rows.ids.map(len)).all()
    decoded = nbest.decode(nbest.encode(docs, MODEL), MODEL).join(docs.withColumnRenamed("text", "given"), "doc_id")
    model = nbest.Segmenter(MODEL)
    assert all(r.text == model.plain(model.normalized(r.given)) for r in decoded.collect())


def test_a_full_memory_of_words_changes_nothing(monkeypatch):
    own, small = nbest.Segmenter(MODEL), nbest.Segmenter(MODEL)
    monkeypatch.setattr(nbest, "CACHE_WORDS", 3)
    texts = ["some words here", "other words there and more", "some words again", ""]
    for text in texts:
        assert small.nbest(text) == own.nbest(text)
    assert [found for _, found in small.all_nbest(texts)] == [own.nbest(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="atheingo .▁\n日é☃0,", max_size=70), max_size=12))
def test_words_searched_in_step_equal_single_ones(texts):
    own = test_best_segmentations_equal_plain_ones.segmenter
    own.forget()
    together = [found for _, found in own.all_nbest(texts)]
    known, found = own.known, own.found
    own.forget()
    assert [own.nbest(t) for t in texts] == together
    for word, n in known.items():
        ids = found.ids[found.starts[n] : found.starts[n + 1]].tobytes()
        assert own.of_word(word) == (found.scores[n], ids, found.losses[n])


def test_the_forward_pass_equals_the_lattice(segmenter):
    for word in ["▁therein", "▁日本x", "\n▁a", "é", "▁" * 5 + "the", "abcdefghij" * 30]:
        arcs = segmenter.lattice(word)
        best, next_best, came, piece = segmenter.forward(word)
        for at in range(1, len(word) + 1):
            assert (best[at], came[at], piece[at]) == arcs[at][0]
            assert next_best[at] == (arcs[at][1][0] if len(arcs[at]) > 1 else float("inf"))
