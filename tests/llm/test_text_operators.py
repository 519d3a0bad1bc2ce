"""Language, quality, HTML, token counts and packing against the libraries or plain versions, and their edge cases."""

from __future__ import annotations

import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import html_text, language, ngram_join, packing, quality, token_counts
from tidemark.llm import words as W

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def odd_texts(n: int = 600) -> list[str]:
    rnd = random.Random(3)
    out = ["", " ", "  \n\n ", "don't we'll I'VE they're 'sam 'S ''s !'s 'll", "a<|endoftext|>b <|startoftext|>\n<|endoftext|>", "İstanbul ΣΑΣ ς", "é é ﬁ ² Ⅷ ٣٤", "a" * 3000 + " " + "xyz" * 900, "日本語 한국어 👩‍👩‍👧", "\x00\x1c\x85a᠎b﻿c", "'", "x'"]
    out += ["".join(rnd.choice("abcdefghistrelmvd' '  0123456789!?.-_ \n\tÉé²中 ") for _ in range(rnd.randint(1, 60))) for _ in range(n)]
    out += ["".join(chr(rnd.choice([rnd.randrange(32, 0x3000), rnd.randrange(32, 0xD800), rnd.randrange(0x10000, 0x11000)])) for _ in range(30)) for _ in range(n // 4)]
    return out


def docs(spark, rows):
    return spark.createDataFrame([(*r, None, None, None)[:5] for r in rows], SCHEMA)


def test_token_counts_are_the_library_s(spark):
    texts = odd_texts()
    expected = [len(e.ids) for e in Tokenizer.from_file(WORD).encode_batch(texts, add_special_tokens=False)]
    got = {r.doc_id: r for r in token_counts.count_tokens(docs(spark, list(enumerate(texts)) + [(-1, None)]), WORD, limit=100).collect()}
    assert [got[i].n_tokens for i in range(len(texts))] == expected
    assert got[-1].n_tokens == 0 and got[-1].n_bytes == 0 and not got[-1].over_limit
    assert all(got[i].n_bytes == len(t.encode()) and got[i].over_limit == (expected[i] > 100) for i, t in enumerate(texts))


def test_state_maps_compose_like_reading(spark):
    t = token_counts.Transducer(WORD)
    symbols = t.symbols("thequickbrownfox" * 40)
    maps = [token_counts.StateMap(t, tuple(symbols[i : i + 7])) for i in range(0, len(symbols), 7)]
    for k, m in enumerate(token_counts.prefix_scan(maps)):
        assert m(0) == t.read(0, symbols[: 7 * (k + 1)])


def test_windows_cover_and_cut_only_between_words():
    cp = W.code_points(["ab cd  efg" * 30, "", "x" * 200, "y z"])
    for limit in (1, 7, 50, 1000):
        parts = list(W.windows(cp, limit))
        assert parts[0][0] == 0 and parts[-1][1] == len(cp) and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
        words = [W.text_of(cp[s:e], a, b) for s, e in parts for a, b in zip(*W.word_bounds(cp[s:e], False)) if cp[s:e][a] < W.PIECE]
        assert words == [w for t in ["ab cd  efg" * 30, "x" * 200, "y z"] for w in t.split()]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 2047, 2048, 2049, 10_000])
def test_piece_lengths_are_powers_of_two(n):
    pieces = packing.piece_lengths(n)
    assert sum(pieces) == n and all(p & (p - 1) == 0 and 0 < p <= 2048 for p in pieces) and pieces == sorted(pieces, reverse=True)
    assert len(set(p for p in pieces if p < 2048)) == len([p for p in pieces if p < 2048])


def test_packing_returns_every_id_once(spark):
    texts = odd_texts(200) + ["word " * 5000]
    expected = [e.ids + [1] for e in Tokenizer.from_file(BYTE).encode_batch(texts, add_special_tokens=False)]
    rows = packing.pack(docs(spark, list(enumerate(texts)) + [(-1, None)]), BYTE).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    found: dict[int, list[int]] = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert r.start == len(found.setdefault(r.doc_id, [])) and len(r.ids) == r.length == 1 << r.bucket and r.offset == 0
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        found[r.doc_id] += r.ids
    assert [found[i] for i in range(len(texts))] == expected and found[-1] == [1]
    assert all(r.doc_tokens == len(found[r.doc_id]) for r in rows)


def test_language_model_is_a_distribution_and_separates(spark, sf_small):
    table = spark.read.parquet(f"{sf_small}/documents.parquet")
    out = language.identify(table.withColumn("language", F.lit("clash")), table.where(F.col("doc_id") % 5 != 0), out="found").cache()
    rows = out.where(F.col("doc_id") % 5 == 0).collect()
    assert np.mean([r.found.lang_pred == r.lang for r in rows]) > 0.95
    assert not any(r.found.rejected for r in rows) and out.columns[-2:] == ["language", "found"]
    counts = {"x": np.unique(language.grams(["abra cadabra"])[0], return_counts=True), "y": np.unique(language.grams(["hocus pocus"])[0], return_counts=True)}
    m = language.kneser_ney(counts)
    context = language.grams(["abr"])[0][-1] << np.uint64(16)
    p = np.exp(m.log_probabilities(context | m.keys[1])).sum(axis=0)
    assert (p < 1 + 1e-6).all() and (p > 0.5).all()  # the rest is for characters never met


def test_language_edge_cases(spark):
    train = spark.createDataFrame([("guten tag " * 30, "de"), ("good day to you " * 30, "en"), (None, "fr"), ("x", None)], "text string, lang string")
    data = docs(spark, [(1, None), (2, ""), (3, "123 !?"), (4, "good day"), (4, "good day"), (None, "tag " * 50_000), (5, "жжж щщщ ыыы " * 9)])
    rows = {r.doc_id: r.language for r in language.identify(data, train, max_chars=100_000).collect()}
    assert [rows[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and all(rows[i].rejected and rows[i].score == 0 for i in (1, 2, 3))
    assert rows[4].lang_pred == "en" and rows[None].lang_pred == "de" and rows[5].rejected and not rows[4].rejected
    assert language.identify(data, train.limit(0)).where("language.lang_pred = 'und' AND language.rejected").count() == 7
    assert language.identify(data.limit(0), train, max_chars=100_000).count() == 0


def test_every_labelled_language_is_learned(spark):
    rnd = random.Random(8)

    def text(letters: str, n: int) -> str:
        return " ".join("".join(rnd.choice(letters) for _ in range(5)) for _ in range(n))

    letters = {f"one{k}": "".join(rnd.sample("abcdefghijklmnopqrstuvwxyz", 7)) for k in range(12)} | {"long": "àèìòùáé", "copies": "бвгджзи"}
    train = [(text(letters[f"one{k}"], 60), f"one{k}") for k in range(12)]  # one text each
    train += [(text(letters["long"], 3000), "long") for _ in range(3)]  # longer than a twentieth of max_chars
    train += [(text(letters["copies"], 300), "copies")] * 400 + [(text(letters["copies"], 60), "copies")] + [("12 34", "digits")]
    train = spark.createDataFrame(train, "text string, lang string")
    names = sorted(letters)
    assert language.fit(train, "text", "lang", 20_000).languages == names
    data = docs(spark, [(i, text(letters[x], 60)) for i, x in enumerate(names)])
    assert {r.doc_id: r.language.lang_pred for r in language.identify(data, train, max_chars=20_000).collect()} == dict(enumerate(names))


def test_quality_held_out_accuracy_and_votes(spark, sf_small):
    table, labels = (spark.read.parquet(f"{sf_small.replace('0.001', '0.01')}/{n}.parquet") for n in ("documents", "labels"))
    out = quality.classify(table, table, labels.where("doc_id % 5 != 0"), out="v").join(labels.where("doc_id % 5 = 0"), "doc_id").collect()
    assert np.mean([(r.v.score >= 0.3) == (r.quality == 1) for r in out]) > 0.93
    x = quality.terms(["Good words stand here. And here.", "BAD!! BAD!! BAD!!", "Good prose is calm. It is.", "AWFUL!! SHOUT!! SHOUT!!"])
    v = quality.learn(x, np.array([1.0, 0, 1, 0]), 4, 2)
    z = x @ v.basis
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    assert np.allclose(z, v.vectors, atol=1e-5) and (v.scores(x) > 0.5).tolist() == [True, False, True, False]


def test_quality_edge_cases(spark):
    data = docs(spark, [(1, "A calm line of prose."), (2, None), (3, ""), (4, "NO!! NO!! NO!!"), (4, "NO!! NO!! NO!!"), (None, "long " * 60_000)])
    labels = spark.createDataFrame([(1, 1), (4, 0), (4, 0), (3, 0), (None, 1), (9, None)], "doc_id bigint, quality int")
    rows = quality.classify(data, data, labels).collect()
    assert len(rows) == 6 and all(0 <= r.quality_vote.score <= 1 for r in rows)
    assert {r.doc_id: r.quality_vote.score for r in rows}[2] == 0.0
    assert {r.quality_vote.score for r in quality.classify(data, data, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(data.limit(0), data, labels).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body class="no-sidebar">
<nav><ul><li><a href=/x>Home</a><li><a href="/y">News, and more.</a></ul></nav><div class="ad">Buy now, friends. Really.</div>
<article><h1>Head &amp; line</h1><p><b>First, a&nbsp;sentence.<br>Second one.<p>Third   paragraph, which is
longer. It goes on.</p><!-- hidden --><ul><li>item one</li><li>item two</ul></article>
<section id="comments"><p>I agree, says a reader. Yes, I do.</p></section><footer>&copy; site. All rights, reserved.</footer></body></html>"""


def test_html_main_text(spark):
    assert html_text.main_text(PAGE) == "Head & line\n\nFirst, a sentence. Second one.\n\nThird paragraph, which is longer. It goes on.\n\nitem one\n\nitem two"
    broken = ["", "plain text.", "<p>a<p>b", "<div><p>x, y.</div></div></p>", "<!-- never ends", "<script>x", "<a href='q>t</a>", "a < b & c > d", "<" * 50, "</p></b>", "<p>" * 2000 + "deep."]
    assert all(isinstance(html_text.main_text(p), str) for p in broken)
    rows = spark.createDataFrame([(1, "u", PAGE, "old"), (2, "u", None, "old"), (3, None, "<p>" + "long text, here. " * 50_000, "old")], "page_id bigint, url string, html string, text string")
    got = {r.page_id: r.text for r in html_text.extract(rows).collect()}
    assert got[1] == html_text.main_text(PAGE) and got[2] == "" and len(got[3]) == len("long text, here. " * 50_000) - 1
    assert html_text.extract(rows.limit(0)).count() == 0 and html_text.extract(rows, out="html").columns[-1] == "html"


TEXT = "A first sentence, which is long enough. A second one follows, and it ends here."


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        (f'<p>{TEXT} See <a href="/item?id=42&ref=share">the report</a>, please.</p>', f"{TEXT} See the report, please."),
        (f'<p data-id="comments">{TEXT}</p>', TEXT),
        (f'<p title="a hidden gem">{TEXT}</p><p data-note="aria-hidden=true display:none">{TEXT}</p>', f"{TEXT}\n\n{TEXT}"),
        (f"<p title=it's>{TEXT}</p><p>It's so.</p>", f"{TEXT}\n\nIt's so."),
        (f"<p>{TEXT}</p><p hidden>Gone, all of it.</p><p style='display: none'>Gone.</p><p ARIA-HIDDEN=true>Gone.</p>", TEXT),
        (f'<div class="layout sidebar-right"><div><p>{TEXT}</p></div><div class="comments"><p>I agree.</p></div></div>', TEXT),
        (f'<p class="social">{TEXT}</p><p class="social">{TEXT}</p><p class="social">{TEXT}</p>', f"{TEXT}\n\n{TEXT}\n\n{TEXT}"),
        (f'<div class="page sidebar-left"><article><p>{TEXT}</p></article><p class="promo">Buy it now, friends.</p></div>', TEXT),
        (f'<article><p>Short. It is.</p></article><div class="comments"><p>{TEXT}</p></div>', "Short. It is."),
        (f'<div class="social-post"><p>{TEXT}</p></div><div class="related"><article>More, of it.</article></div>', TEXT),
        (f'<div><svg class="i" /><p>{TEXT}</p><object data=x/></object><p>{TEXT}</p></div>', f"{TEXT}\n\n{TEXT}"),
        (f"<div><svg><path d=''><p>{TEXT}</p></div><div><svg><text>no</text></svg><p>{TEXT}</p></div>", f"{TEXT}\n\n{TEXT}"),
        (f"<p>{TEXT}</p><iframe src='x'/><p>{TEXT}</p><math><mi>x<p>{TEXT}</p>", f"{TEXT}\n\n{TEXT}\n\nx\n\n{TEXT}"),
        (f"<p>An <svg><svg><text>a</text></svg><text>b</text></svg>icon. {TEXT}</p><script>x", f"An icon. {TEXT}"),
        (f"<html><head><title>T</title><body><p>{TEXT}</p></body></html>", TEXT),
    ],
)
def test_html_keeps_article_text(page, expected):
    assert html_text.main_text(page) == expected


def test_html_forms_go_by_their_weight():
    page = f"<nav>Menu</nav><article><p>{TEXT}</p><p>{TEXT}</p></article><footer>Legal</footer>"
    whole = f"{TEXT}\n\n{TEXT}"
    asked = "<form><p>Your name, please.</p><input><select><option>One</option></select><button>Send</button></form>"
    assert html_text.main_text(f"<body><form id=aspnet action='/'>{page}</form></body>") == whole
    assert html_text.main_text(f"<body><form>{page}</form></body>") == whole
    assert html_text.main_text(f"<body>{page}{asked}</body>") == whole
    assert html_text.main_text(f"<body>{page.replace('</article>', asked + '</article>')}</body>") == whole
    assert html_text.main_text(f"<body><form>{page.replace('</article>', asked + '</article>')}</form></body>").startswith(whole)
    assert html_text.main_text(f"<body><form hidden>{page}</form></body>") == ""


@pytest.mark.parametrize("page, size", [
    ("<body><p>" + "<b>word</b> " * 100_000, 499_999), ("<body><p>" + "<b>word " * 100_000, 499_999),
    ("<body>" + "<div>text " * 5_000, 29_998), ("<p><table>" + "<div>x" * 20_000, 59_998), ("<div>" * 50_000 + "</x>" * 50_000, 0)],
    ids=["closed inline", "open inline", "deep", "blocks below a paragraph", "stray ends"])
def test_html_time_is_linear_in_tags_and_depth(page, size):
    start = time.process_time()
    assert len(html_text.main_text(page)) == size
    assert time.process_time() - start < 10  # about 0.5 s; a scan of the open tags per tag takes minutes



def test_html_on_the_pages_table(spark, sf_small):
    import html as library
    import re

    for r in html_text.extract(spark.read.parquet(f"{sf_small}/pages.parquet")).collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S).group(1)
        blocks = [" ".join(library.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(b for b in blocks if b)


def thue_morse(size, a, b):
    bits = [0]
    while len(bits) < size:
        bits += [1 - k for k in bits]
    return ["".join((a, b)[k ^ flip] for k in bits) for flip in (0, 1)]


def test_words_that_make_polynomial_hashes_collide():
    texts = [w for size in (1024, 4096) for a, b in (("a", "n"), ("s", "t"), ("x", "y"), ("é", "ü")) for w in thue_morse(size, a, b)]
    packs = Tokenizer.from_file(BYTE)
    want = [np.array([*e.ids, 1], "<u4").tobytes() for e in packs.encode_batch(texts, add_special_tokens=False)]
    assert packing.Encoder(BYTE, 1).ids(texts) == want
    counts = Tokenizer.from_file(WORD)
    assert token_counts.Counter(WORD).counts(texts).tolist() == [len(e.ids) for e in counts.encode_batch(texts, add_special_tokens=False)]
    assert len({int(s[0]) for s in ngram_join.gram_sets(texts)}) == len(texts)


def test_words_with_one_equal_hash_are_told_apart(monkeypatch):
    real = W.word_hashes
    monkeypatch.setattr(W, "word_hashes", lambda *x: (real(*x)[0] % np.uint64(3), real(*x)[1]))
    texts = ["a b c d e f g a b", "zebra lion a", ""]
    packs = Tokenizer.from_file(BYTE)
    encoder = packing.Encoder(BYTE, 1)
    for _ in range(2):
        assert encoder.ids(texts) == [np.array([*e.ids, 1], "<u4").tobytes() for e in packs.encode_batch(texts, add_special_tokens=False)]
    counts = Tokenizer.from_file(WORD)
    counter = token_counts.Counter(WORD)
    for _ in range(2):
        assert counter.counts(texts).tolist() == [len(e.ids) for e in counts.encode_batch(texts, add_special_tokens=False)]
