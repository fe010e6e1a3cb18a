"""Alignments against a plain reading of the definition."""

import functools
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest

from arbolytics.llm import alignment as G
from arbolytics.llm.byte_bpe import byte_characters

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    byte = {c: i for i, c in enumerate(byte_characters())}
    bytes_a = lambda i: bytes(byte[c] for c in a.id_to_token(i))
    bytes_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    return (lambda t: a.encode(" " + t, add_special_tokens=False).ids), (lambda t: b.encode(t)), bytes_a, bytes_b


def brute(rows, libraries):
    enc_a, enc_b, bytes_a, bytes_b = libraries
    made, documents = [], Counter()
    for d, text in rows:
        raw = (" " + (text or "")).encode()
        a, b = (enc_a(text), enc_b(text)) if text else ([], [])
        sa, sb = [bytes_a(i) for i in a], [bytes_b(i) for i in b]
        if not text or b"".join(sa) != raw or b"".join(sb) != raw:
            made.append((d, [], [], [], []))
            continue
        spans = []
        for parts in (sa, sb):
            at, out = 0, []
            for x in parts:
                out.append((at, at + len(x)))
                at += len(x)
            spans.append(out)
        ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, start = [], 0
        for e in ends:
            groups.append(([i for i, s in zip(a, spans[0]) if start <= s[0] and s[1] <= e], [i for i, s in zip(b, spans[1]) if start <= s[0] and s[1] <= e]))
            start = e
        links = [(i, j) for i, s in zip(a, spans[0]) for j, t in zip(b, spans[1]) if max(s[0], t[0]) < min(s[1], t[1])]
        documents.update(set(links))
        made.append((d, a, b, groups, links))
    best = defaultdict(int)
    for (i, _), n in documents.items():
        best[i] = max(best[i], n)
    out = []
    for d, a, b, groups, links in made:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((d, len(a), len(b), len(groups), len(links), sum(documents[x] == best[x[0]] for x in links), sum(documents[x] for x in links),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr), {(i, j, n, n == best[i]) for (i, j), n in documents.items()}


def some_rows():
    pick = random.Random(5)
    kinds = ["the quick brown", "naïve façade", "日本語のテキスト", "def f(x):\n\treturn x", "  two  blanks ", "1234567 89", "don't we'll", "🙂🙂", "x" * 40,
             "résumé ", "Привет мир", "\r\n\r\n", "<|endoftext|>", "<s> </s>", "á e", "…", " ", "ArbolyticsUnbelievableWords"]
    rows = [(d, " ".join(pick.choices(kinds, k=pick.randrange(1, 12)))) for d in range(40)]
    return rows + [(50, None), (51, ""), (52, " "), (53, "a"), (54, "has ▁ mark"), (55, "<0x0A>"), (3, rows[3][1]), (None, rows[3][1]), (56, "x\x00y")]


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("size", [20, 1 << 16])
def test_texts(docs, monkeypatch, libraries, size):
    """Also with texts cut into many byte ranges, and with packs of a few texts."""
    monkeypatch.setattr(G, "RANGE_CHARS", size)
    monkeypatch.setattr(G, "PACK_BYTES", 500)
    monkeypatch.setattr(G, "FAN", 3)
    rows, (wanted, pairs) = some_rows(), brute(some_rows(), libraries)
    got = G.align(docs(rows), A, B)
    assert sorted(map(tuple, got.documents.select(NAMES).collect()), key=repr) == wanted
    assert {tuple(r) for r in got.pairs.collect()} == pairs


def test_words_are_known_or_not(libraries, monkeypatch):
    """A cache that is emptied all the time, and words joined by few or many, change nothing."""
    texts = [t for _, t in some_rows() if t] + ["plain words and others here", "bad ▁ one", "two  blanks", " begins", "ends "]
    found = []
    for known, joined in ((0, 3), (10 ** 6, 2000)):
        monkeypatch.setattr(G, "MOST_KNOWN", known)
        monkeypatch.setattr(G, "JOINED", joined)
        table, out = G.WordTable(*G.vocabularies(A, B)), {}
        for part in (texts[:20], texts[20:]):
            for places, words in G.words_of(part):
                x = table(places, words)
                out.update({part[p]: (n, d) for p, n, d in zip(x.places, x.numbers.tolist(), x.digests)})
        found.append(out)
    assert found[0] == found[1]
    wanted = {t: (list(r[1:5]), r[-1]) for t in texts for r in brute([(1, t)], libraries)[0] if r[-1]}
    assert found[0] == wanted


def test_groups(docs, monkeypatch, libraries):
    monkeypatch.setattr(G, "RANGE_CHARS", 30)
    rows = [(d, t) for d, t in some_rows() if d is not None and d > 3]
    found = defaultdict(list)
    for r in sorted(G.aligned_groups(docs(rows), A, B).collect(), key=lambda r: (r.doc_id, r.place)):
        found[r.doc_id] += [",".join(map(str, g.a)) + "|" + ",".join(map(str, g.b)) for g in r.groups]
    wanted = {r[0]: r[-1] for r in brute(rows, libraries)[0] if r[-1]}
    assert {d: hashlib.sha256(";".join(x).encode()).hexdigest() for d, x in found.items()} == wanted


def test_no_documents(spark, docs):
    assert G.align(docs([]), A, B).documents.count() == 0
    df = spark.createDataFrame([(1, "some text", 1, 2, "k")], "doc_id long, text string, pack int, key int, place string")
    assert G.align(df, A, B).documents.columns == NAMES


def test_ranges_keep_the_text():
    text = "one  two threé four ́five " + "x" * 50 + " six\n seven eight "
    parts = list(G.ranges(text, 4))
    assert " ".join(parts) == text and len(parts) > 3
    assert list(G.ranges("nothing", 2)) == ["nothing"]


def compose_in_any_order(fragments, pick):
    parts = list(fragments)
    while len(parts) > 1:
        at = pick.randrange(len(parts) - 1)
        parts[at:at + 2] = [G.compose(parts[at], parts[at + 1])]
    return parts[0]


def test_fragments_of_any_byte_ranges():
    """Ranges that cut anywhere, also through tokens, compose to the same groups in any bracketing."""
    for seed in range(200):
        pick = random.Random(seed)
        total = pick.randrange(1, 60)
        ends = [np.array(sorted({*pick.sample(range(1, total + 1), pick.randrange(0, total)), total})) for _ in range(2)]
        ids = [list(range(len(e))) for e in ends]
        cuts = sorted({0, total, *pick.sample(range(total), pick.randrange(0, min(total, 9)))})
        made, inner = [], []
        for n, (s, e) in enumerate(zip(cuts, cuts[1:])):
            mine = [[i for i in x if s < y[i] <= e] for x, y in zip(ids, ends)]
            f, run = G.fragment_of(n, mine[0], ends[0][mine[0]], mine[1], ends[1][mine[1]])
            made.append(f)
            if run[0]:
                inner.append((2 * n + 1, *run))
        whole = compose_in_any_order(made, pick)
        left = functools.reduce(G.compose, made)
        assert (whole.first, whole.prefix, whole.suffix, sorted(whole.closed)) == (left.first, left.prefix, left.suffix, sorted(left.closed))
        assert whole.suffix == ([], [])
        runs = sorted([*inner, (2 * whole.first, *whole.prefix), *[(2 * c, a, b) for c, a, b in whole.closed]])
        assert [i for _, a, _ in runs for i in a] == ids[0] and [j for _, _, b in runs for j in b] == ids[1]
        for place, a, b in runs:
            assert ends[0][a[-1]] == ends[1][b[-1]]
            if place % 2 == 0:
                shared = set(ends[0][a].tolist()) & set(ends[1][b].tolist())
                assert len(shared) == 1
