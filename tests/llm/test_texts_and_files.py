"""Languages, vectors, tokens, pages, archives and benchmark items."""

import base64
import hashlib
import random
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
import zstandard
from tokenizers import Tokenizer
from pyspark.sql import functions as F

from arbolytics.llm import byte_bpe as B, decontaminate as D, html_text as H, language_id as I, neighbours as V, token_files as T, warc as W

RANKS, WORDS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "\n", "a", " a", "a ", "a  b   c", "a\n b\n\n c", "\n \nb", "a \nb", "tab\t\tx\x0b y\x0c", "a\x1c b", "a \x1cb", "a\x85b  c",
       "日本語テスト🙂🙂 x\n\n\n  y", "İıſK ǅ ΑΣ ΑΣ'", "don't 'S 'll 'LL", "a" * 700, "١٢٣ ½ Ⅷ", "é ́x ́", "<|endoftext|> a<|startoftext|>",
       "x y　z", "​​ a", "The quick brown fox, jumps; over 12 lazy dogs!" * 20, "x" * 50_000 + " y " * 3000]


def odd_rows(docs):
    return docs([(i, t, 1) for i, t in enumerate(ODD)] + [(3, "again", 1), (3, "again", 1), (90, None, 1)], "doc_id long, text string, ids int")


def test_byte_ids_are_those_of_the_rank_file(docs):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted([(i, known.encode_ordinary(t)) for i, t in enumerate(ODD)] + [(3, known.encode_ordinary("again"))] * 2 + [(90, [])])
    ids = B.encode_column(odd_rows(docs), RANKS, public_tokenizers.PATTERN)
    assert sorted((r.doc_id, list(r.ids)) for r in ids.collect()) == want
    decoded = {(r.doc_id, bytes(r.decoded)) for r in B.decode_column(ids, RANKS).collect()}
    assert decoded == {(i, t.encode()) for i, t in enumerate(ODD)} | {(3, b"again"), (90, b"")}
    trip = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in B.round_trip(odd_rows(docs), RANKS, public_tokenizers.PATTERN).collect()}
    texts = {**dict(enumerate(ODD)), 90: ""}
    sha = lambda x: hashlib.sha256(x).hexdigest()
    assert {x for x in trip if x[0] != 3} == {(i, len(x), sha(",".join(map(str, x)).encode()), sha(texts[i].encode())) for i, x in want if i != 3}
    assert B.round_trip(docs([]), RANKS, public_tokenizers.PATTERN).count() == 0


def test_offsets_of_ids(docs):
    text = "Grüße 🙂 an alle"
    row = B.encode_column(docs([(1, text)]), RANKS, public_tokenizers.PATTERN, offsets=True).first()
    assert row.starts[0] == 0 and row.ends[-1] == len(text) and len(row.starts) == len(row.ids)
    assert all(0 <= a <= b <= len(text) for a, b in zip(row.starts, row.ends))


def test_token_files(docs, spark, tmp_path):
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    rows = [(i * 3 % 101, t, 0) for i, t in enumerate(ODD)] + [(7, None, 0), (None, "no id", 0), (200, "twice", 0), (200, "twice", 0)]
    df = docs(rows, "doc_id long, text string, part int")
    manifest = T.write_token_files(df, str(tmp_path / "t"), WORDS, 2, frame_bytes=400, file_text_bytes=20_000)
    got = T.read_token_files(manifest).collect()
    ids = lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
    assert sorted((-1 if r.doc_id is None else r.doc_id, list(r.ids)) for r in got) == sorted((-1 if d is None else d, ids(t)) for d, t, _ in rows)
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:i]) for i in range(len(got))]
    assert [-1 if r.doc_id is None else r.doc_id for r in got] == sorted(-1 if d is None else d for d, _, _ in rows)
    sums = {(r.doc_id, r.ids_crc32) for r in T.read_token_files(manifest, with_ids=False).collect()}
    assert sums == {(d, zlib.crc32(np.array(ids(t), "<u4").tobytes())) for d, t, _ in rows}
    assert T.read_documents(spark, manifest, [200, 7]) == {200: ids("twice"), 7: [2]}
    assert T.read_documents(spark, manifest, [10_000, -1]) == T.read_documents(spark, manifest, []) == {}
    assert T.read_documents(spark, manifest, [0, 3]) == {0: ids(ODD[0]), 3: ids(ODD[1])}  # the row without an id is not 0
    opened = manifest.filter("200 BETWEEN least_id AND greatest_id").count()
    assert 0 < opened < manifest.count() == T.read_token_files(manifest).select(F.spark_partition_id()).distinct().count()
    assert T.read_token_files(T.write_token_files(docs([]), str(tmp_path / "e"), WORDS, 2)).count() == 0

    path = manifest.first().file
    raw = open(path, "rb").read()
    n, _, magic = struct.unpack("<IBI", raw[-9:])
    assert magic == T.SEEK_MAGIC and n > 1
    whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    first = struct.unpack("<III", raw[-9 - 12 * n:-9 - 12 * n + 12])
    assert xxhash.xxh64_intdigest(whole[:first[1]]) & 0xFFFFFFFF == first[2]
    broken = bytearray(raw)
    broken[20] ^= 1
    bad = tmp_path / "bad"
    bad.write_bytes(broken)
    import pyarrow.fs as pafs
    with pafs.LocalFileSystem().open_input_file(str(bad)) as source, pytest.raises(Exception):
        list(T.FileReader(source).documents(range(3)))


def test_items_without_an_id_are_found(docs, monkeypatch):
    items = ["the first passage of the benchmark set", "another passage that nobody has numbered", "a third one without any number at all"]
    df = docs([(1, f"x {items[0]} y"), (2, f"x {items[1]} y"), (3, " ".join(items)), (4, "clean"), (5, None)])
    for chars in (D.BLOCK_CHARS, 10):  # in one block, in a block each
        monkeypatch.setattr(D, "BLOCK_CHARS", chars)
        benchmark = docs([(7, items[0]), (None, items[1]), (None, items[2]), (8, None), (None, None)], "item_id long, text string")
        got = {r.doc_id: (r.contaminated, r.n_items, r.item_ids) for r in D.contaminated(df, benchmark).collect()}
        assert got == {1: (True, 1, [7]), 2: (True, 1, [None]), 3: (True, 2, [7, None]), 4: (False, 0, []), 5: (False, 0, [])}


PAGE = """<html><head><title>x</title><script>var t="</p>";</script></head><body class="has-sidebar"><nav><a href="/">Home</a></nav>
<div class="ad">Buy</div><article><h1>A &amp; B</h1><p><b>One <i>tw</i>o.<br><p>Three&nbsp; four</p>
<section id="comments"><article>first!</article></section><form><p>mail</p></form><p>five &lt;six&gt;</article><footer>&copy; x</footer></body></html>"""


def test_article_of_a_page(docs):
    rows = [(1, "http://a.org/1", PAGE), (2, None, None), (3, "x", ""), (1, "http://a.org/1", PAGE), (None, "http://a.org/2", "<p>just this")]
    df = docs([(*r, 0, 1) for r in rows], "page_id long, url string, html string, key int, text int")
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in H.extract_text(df).collect()), key=repr)
    text = "A & B One two. Three four five <six>"
    assert got == sorted([(1, "http://a.org/1", text, len(text))] * 2 + [(2, None, "", 0), (3, "x", "", 0), (None, "http://a.org/2", "just this", 9)], key=repr)
    assert H.extract_text(docs([], "page_id long, url string, html string")).count() == 0


def test_captions_formulas_and_titled_sections_stay():
    page = """<article><figure><img><figcaption>A caption</figcaption></figure><math><mi>x</mi><mo>=</mo><mn>2</mn></math>
<object data="a">an object</object><canvas>a drawing</canvas><section id="related-work"><h2 id="search">Search</h2><p>text</section>
<section id="comments"><p>first</section><section id="x" class="related"><p>more</section><div id="related">else</div></article>
<section id="cookies">ok</section>"""
    assert H.main_text(page, []) == "A caption x = 2 an object a drawing Search text"


def test_lines_shared_with_the_nearest_pages_go(docs):
    page = lambda i: f"<div>Our shop</div><div>Welcome to page</div><p>Text {i} of its own</p><div>All rights reserved</div>"
    rows = [(i, f"http://h{i % 2}.org/a/{i:03d}?q=1", page(i)) for i in range(30)] + [(90 + i, "http://h0.org/a/000", page(0)) for i in range(3)]
    got = {r.page_id: r.text for r in H.extract_text(docs(rows, "page_id long, url string, html string")).collect()}
    assert got == {**{i: f"Text {i} of its own" for i in range(30)}, 90: "Text 0 of its own", 91: "Text 0 of its own", 92: "Text 0 of its own"}


def test_longest_common_subsequence():
    def length(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
            row = new
        return row[-1]

    pick = random.Random(4)
    for _ in range(500):
        a, b = ([pick.randrange(4) for _ in range(pick.randrange(12))] for _ in range(2))
        got, rest = H.common_lines(a, b), iter(b)
        assert len(got) == length(a, b) and got == sorted(set(got)) and all(a[i] in rest for i in got)


def test_archives(docs, tmp_path):
    big = "<p>é</p>" * 200
    rows = [(1, "http://a/\n1", big), (5, "http://a/5", big), (3, None, big), (None, "n", big), (5, "http://a/5", big), (6, "s", "short"),
            (7, "s2", "short"), (8, "e", None), (9, "e", "")]
    df = docs([(*r, "x", 1) for r in rows], "page_id long, url string, html string, payload string, file int")
    index = W.write_archives(W.classify(df), str(tmp_path / "w"), file_bytes=300)
    got = W.read_records(index).collect()
    size, digest = len(big.encode()), hashlib.sha1(big.encode()).hexdigest()
    facts = lambda r: (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
    short, none = hashlib.sha1(b"short").hexdigest(), hashlib.sha1(b"").hexdigest()
    assert sorted(map(facts, got), key=repr) == sorted(
        [(p, size, digest, "revisit", 5) for p in (1, 3, None)] + [(5, size, digest, "response", None)] * 2
        + [(6, 5, short, "response", None), (7, 5, short, "response", None), (8, 0, none, "response", None), (9, 0, none, "response", None)], key=repr)
    assert {r.url for r in got} == {"http://a/%0A1", "http://a/5", None, "n", "s", "s2", "e"}
    assert all((r.payload is None) == (r.record_type == "revisit") for r in got)
    assert W.read_records(index, task_bytes=200).select(F.spark_partition_id()).distinct().count() > 4  # one file in several tasks
    some = W.read_records(index.filter("page_id = 6")).collect()
    assert [bytes(r.payload) for r in some] == [b"short"]
    assert W.read_records(W.write_archives(W.classify(docs([], "page_id long, url string, html string")), str(tmp_path / "e"))).count() == 0


def test_ranges_cover_their_records():
    pick, places, at = random.Random(1), [], 0
    for _ in range(800):
        size = pick.randrange(1, 20_000)
        places.append((at, size))
        at += size + (pick.random() < 0.1) * 100_000
    seen = 0
    for first, end, start, size in W.ranges(places):
        assert first == seen and all(start <= a and a + n <= start + size for a, n in places[first:end])
        seen = end
    assert seen == len(places) and list(W.ranges([])) == []


def best_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_distance_of_a_passage():
    pick = random.Random(3)
    for _ in range(600):
        pattern, text = ("".join(pick.choices("abc", k=pick.randrange(low, 14))) for low in (1, 0))
        most = pick.randrange(4)
        assert D.within(pattern, text, most) == (best_distance(pattern, text) <= most)


def test_benchmark_items(docs, spark, words, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_CHARS", 300)  # several automata
    pick = random.Random(6)
    items = [(i, " ".join(words(pick.randrange(3, 40), i))) for i in range(12)] + [(50, None), (51, ""), (None, "w1 w2"), (12, "Short One")]
    rows = []
    for d in range(60):
        item = list(items[d % 12][1].upper() if d % 3 else items[d % 12][1])
        for _ in range(pick.randrange(9)):
            item[pick.randrange(len(item))] = pick.choice("xyz ")
        rows.append((d, " ".join(words(20, 90 + d)) + "\n " + "".join(item) + " " + " ".join(words(9, 300 + d)), 0))
    rows += [(70, None, 0), (71, "", 0), (72, "a short   one b", 0), (None, items[0][1], 0), (72, "a short   one b", 0)]
    benchmark = docs([(*x, 1) for x in items], "item_id long, text string, doc_id int")
    got = D.contaminated(docs(rows, "doc_id long, text string, item_ids int"), benchmark).collect()
    want = []
    for d, t, _ in rows:
        text = " ".join((t or "").lower().split())
        found = [i for i, x in items if x and i is not None and text and best_distance(
            " ".join(x.lower().split()), text) <= D.budget(len(" ".join(x.lower().split())))]
        want.append((d, bool(found), len(found), found))
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)
    assert sum(bool(w[1]) for w in want) > 20
    none = D.contaminated(docs(rows, "doc_id long, text string, item_ids int"), benchmark.limit(0)).collect()
    assert {(r.contaminated, r.n_items, len(r.item_ids)) for r in none} == {(False, 0, 0)}
    assert D.contaminated(docs([]), benchmark).count() == 0


def text_in(language, n, seed):
    pick = random.Random(f"{language}{seed}")
    parts = {"aa": ["ka", "lo", "mi", "tar", "en"], "bb": ["shu", "or", "ez", "kw", "ith"], "cc": ["ñu", "éa", "lo", "rr", "io"]}[language]
    return " ".join("".join(pick.choices(parts, k=pick.randrange(1, 5))) for _ in range(n))


def test_languages(docs):
    rows = [(i, text_in(lang, 5 + i % 40, i), lang, "x") for i, lang in ((i, ("aa", "bb", "cc")[i % 3]) for i in range(600))]
    rows += [(900, None, "aa", "x"), (901, "12 !", "bb", "x"), (902, "", None, "x"), (None, text_in("bb", 20, 7), None, "x"), (903, "漢字" * 50, None, "x"),
             (5, text_in("cc", 20, 8), None, "x")]
    df = docs(rows, "doc_id long, text string, lang string, score string")
    got = I.identify(df, learn=~I.held_out(df.doc_id.cast("long"))).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert [(by_id[i].lang_pred, by_id[i].score, by_id[i].rejected) for i in (900, 901, 902)] == [("und", 0.0, True)] * 3
    assert by_id[None].lang_pred == "bb" and by_id[903].rejected
    held = [r for r in got if r.doc_id is not None and r.doc_id < 600 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    right = [r.lang_pred == ("aa", "bb", "cc")[r.doc_id % 3] for r in held if r.doc_id != 5]
    assert sum(right) / len(right) > 0.97 and not any(r.rejected for r in held)
    none = I.identify(docs([(1, "text", None)], "doc_id long, text string, lang string")).collect()
    assert [(r.lang_pred, r.score, r.rejected) for r in none] == [("und", 0.0, True)]


def test_all_ngrams_of_a_large_language_count(docs):
    pick = np.random.default_rng(3)
    texts = ["".join(map(chr, pick.integers(0x4E00, 0x9F00, 15_000))) for _ in range(40)]
    texts[0] += " ab"
    df = docs([(i, t, "zh") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    order = {r.doc_id: r.o for r in df.selectExpr("doc_id", "pmod(xxhash64(cast(doc_id as string), 'calibration'), 10) AS o").collect()}
    keys, counts = np.unique(I.packed_grams([t for i, t in enumerate(texts) if order[i] != 0])[0], return_counts=True)
    assert len(keys) > 400_000  # more than were kept once
    want, got = I.Language.fit("zh", keys, counts), I.train(df).languages[0]
    assert [len(t.hashes) for t in got.probabilities] == [len(t.hashes) for t in want.probabilities]
    assert np.allclose(got.score(keys[:5000]), want.score(keys[:5000]))


def test_model_is_a_distribution():
    grams = I.packed_grams(["banana band bandana", "an ant"])[0]
    keys, counts = np.unique(grams, return_counts=True)
    language = I.Language.fit("x", keys, counts)
    symbols = np.unique(keys & np.uint64(0xFFFF))
    for context in np.unique(keys >> np.uint64(16))[:10]:
        total = np.exp(language.score((context << np.uint64(16)) | symbols)).sum() + np.exp(language.unseen) * np.exp(0)
        assert total <= 1.02


def test_nearest_vectors(docs):
    make = np.random.default_rng(5)
    centres = make.standard_normal((12, 24))
    data = centres[make.integers(0, 12, 3000)] + make.standard_normal((3000, 24)) * 0.6
    data[7] *= 3
    rows = [(i, v.tolist(), 1) for i, v in enumerate(data)]
    odd = [(4000, None, 1), (4020, [0.0] * 24, 1), (4040, [float("nan")] * 24, 1), (4060, [None] + [1.0] * 23, 1), (4080, [], 1),
           (4100, [float("inf")] * 24, 1), (None, [1.0] * 24, 1)]
    df = docs(rows + odd, "vec_id long, embedding array<double>, rank int")
    got = V.nearest(df, df.filter("vec_id % 20 = 0"), 20).collect()
    assert len(got) == 150 * 20
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append(r.vec_id)
        assert abs(r.score - data[r.query_id] @ data[r.vec_id]) < 1e-9
    hits = 0
    for q, ids in found.items():
        scores = data @ data[q]
        scores[q] = -np.inf
        assert q not in ids and list(np.lexsort((ids, -scores[ids]))) == list(range(20))
        hits += len(set(ids) & set(np.argsort(-scores)[:20].tolist()))
    assert hits / (150 * 20) >= 0.9


def test_few_vectors_and_ties(docs):
    twice = docs([(i, [float(i), 1.0]) for i in range(1, 30)] + [(20, [0.0, 1.0])], "vec_id long, embedding array<double>")
    got = V.nearest(twice, twice.filter("vec_id = 20"), 20).collect()
    assert len(got) == 40 and sorted(r.rank for r in got) == sorted([*range(1, 21)] * 2) and {r.query_id for r in got} == {20}
    df = docs([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 0.0]), (20, [1.0, 1.0]), (3, [1.0, 0.0])], "vec_id long, embedding array<double>")
    got = V.nearest(df, df.filter("vec_id = 20"), 20).orderBy("rank").collect()
    assert [(r.rank, r.vec_id, r.score) for r in got] == [(1, 1, 1.0), (2, 2, 1.0), (3, 3, 1.0), (4, 3, 1.0)]
    assert V.nearest(df.limit(0), df.limit(0)).count() == 0


def test_broken_markup():
    assert H.main_text('<p title="a > b">one</p><p title="open>two</p><p>three', []) == "one two three"
    assert H.main_text("<p>a<!-- <p>b --><!-- open <p>c", []) == "a"
    assert H.main_text("<ul><li>x<li>y</ul><script>if (a < b) {}</script>z<style>p{}", []) == "x y z"
    assert H.main_text("<<p>>1 < 2 &amp;amp; &#x41;&bogus;</div></p></span>", []).endswith("1 < 2 &amp; A&bogus;")
    assert H.main_text("<a '" * 20_000 + "<p>end", []).endswith("end")


def test_plain_boilerplate_of_an_article_goes(docs):
    """Unmarked template lines inside the article; copies and shared sentences stay."""
    def page(i, extra=""):
        return (f"<body><div>Shop</div><article><header><h1>Title {i}</h1></header><p>First {i}</p><div>Tell your friends</div><p>Second {i}</p>"
                f"<p>Third {i}</p><p>On every page</p>{extra}<ul><li>Elsewhere</ul><p class='social-policy'>Fourth {i}</p>"
                f"<ul><li>Fifth {i}<li>Sixth {i}<li>Seventh {i}<li>Eighth {i}<li>Ninth {i}</ul></article></body>")

    rows = [(i, f"http://h.org/{i:02d}", page(i, "<p>One sentence of two pages</p>" if i in (3, 4) else "")) for i in range(8)]
    copies = [(20 + i, f"http://c.org/{i}", page(1, f"<p>copy {i}</p>")) for i in range(3)]
    got = {r.page_id: r.text for r in H.extract_text(docs(rows + copies, "page_id long, url string, html string")).collect()}
    for i in range(8):
        # The first and the last page have one neighbour, which does not take away a list.
        every = " Elsewhere" if i in (0, 7) else ""
        two = " One sentence of two pages" if i in (3, 4) else ""
        assert got[i] == f"Title {i} First {i} Second {i} Third {i} On every page{two}{every} Fourth {i} Fifth {i} Sixth {i} Seventh {i} Eighth {i} Ninth {i}"
    for i in range(3):
        assert got[20 + i] == f"Title 1 First 1 Tell your friends Second 1 Third 1 On every page copy {i} Elsewhere Fourth 1 Fifth 1 Sixth 1 Seventh 1 Eighth 1 Ninth 1"


def test_article_with_template_lines_only_is_not_emptied(docs):
    rows = [(i, f"http://h.org/{i}", f"<nav>{i}</nav><main><div>Soon</div></main>") for i in range(4)]
    assert {r.text for r in H.extract_text(docs(rows, "page_id long, url string, html string")).collect()} == {"Soon"}


def test_inline_elements_and_class_words_of_an_article():
    page = ("<article><p>a<img>b<x-note>c</x-note></p><div class='search-results'>found</div><div class='share'>tell</div>"
            "<div class='ad-slot'>buy</div><ul class='comment-list'><li>first</ul></article>")
    assert H.main_text(page, []) == "abc found"


def test_differences_by_brute_force(spark):
    """Pairing and deletion of all given small pages, without Spark and without hashes."""
    def common(a, b):
        best = [[()] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = (*best[i][j], i) if x == y else max(best[i][j + 1], best[i + 1][j], key=len)
        return set(best[-1][-1])

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    parsed, hosts = {}, {}
    for r in pages.collect():
        parsed[r.page_id] = H.lines_of(r.html or "")
        host, path = re.match(r"(?:[a-z]+:)?//([^/?#]*)([^?#]*)", r.url).groups()
        if parsed[r.page_id][0]:
            key = tuple(parsed[r.page_id][0]), tuple(parsed[r.page_id][1])
            hosts.setdefault(host.lower(), {}).setdefault(key, []).append((path, r.page_id))
    wanted = {k: " ".join(x for x, s in zip(v[0], v[1], strict=True) if not s) for k, v in parsed.items()}
    changed = set()
    for group in hosts.values():
        order = sorted(min(v) for v in group.values())
        for at, (_, page_id) in enumerate(order):
            lines, skipped, needs, named = parsed[page_id]
            assert named
            kept = [i for i, s in enumerate(skipped) if not s]
            body = [i for i in kept if needs[i] > 1] or kept
            seen = [common(lines, parsed[order[o][1]][0]) for o in (at - 1, at + 1) if 0 <= o < len(order)]
            seen = [x for x in seen if 4 * len(x.intersection(body)) <= len(body)]
            left = [i for i in kept if sum(i in x for x in seen) < needs[i]] or kept
            for _, other in next(v for v in group.values() if page_id in [p for _, p in v]):
                changed |= {other} if left != kept else set()
                wanted[other] = " ".join(parsed[other][0][i] for i in left)
    assert {r.page_id: r.text for r in H.extract_text(pages).collect()} == wanted
