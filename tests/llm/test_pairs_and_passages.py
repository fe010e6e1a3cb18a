"""Passages, n-gram classes and lines against brute force."""

import itertools
import random

import pytest

from arbolytics.llm import line_dedup as L, ngram_join as N, packed, substring_dedup as S
from arbolytics.llm.components import components

CLASHING = "doc_id long, text string, grp int, node long, line string, _x int, n_removed int"


def brute_passages(rows, window):
    cut = [(d, (t or "").encode().split()) for d, t in rows]
    least = {}
    for d, ws in cut:
        for i in range(len(ws) - window + 1):
            key = tuple(ws[i:i + window])
            least[key] = min(least.get(key, 1 << 62), 1 << 62 if d is None else d)
    out = []
    for d, ws in cut:
        gone = set()
        for i in range(len(ws) - window + 1):
            if least[tuple(ws[i:i + window])] < (1 << 62 if d is None else d):
                gone.update(range(i, i + window))
        out.append((d, len(ws), len(gone), " ".join(w.decode() for i, w in enumerate(ws) if i not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window", [2, 5, 8])
def test_passages(docs, words, window):
    pick = random.Random(window)
    pool = [words(30, s) for s in range(4)]
    rows = []
    for d in range(40):
        parts = [x[a:a + pick.randrange(1, 25)] for x in pick.choices(pool, k=3) for a in [pick.randrange(15)]]
        rows.append((d // 2 if d > 30 else d, " ".join(itertools.chain(*parts, words(pick.randrange(4), 100 + d)))))
    rows += [(50, None), (51, ""), (52, " \n\t "), (None, rows[3][1]), (3, rows[3][1]), (53, "é ü\x0bß " * 10), (54, "x\x1cy é ü\x0bß " * 3)]
    got = S.substring_dedup(docs(rows), window).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert sorted(map(tuple, got), key=repr) == brute_passages(rows, window)


def test_passages_empty_and_spans(docs):
    assert S.substring_dedup(docs([])).count() == 0
    text = " ".join(map(str, range(60)))
    got = {r.doc_id: r for r in S.substring_dedup(docs([(1, text), (2, "a b " + text + " c")]), 50).collect()}
    assert got[1].removed == [] and [tuple(x) for x in got[2].removed] == [(2, 62)] and got[2].kept_text == "a b c"


def test_hashes_of_words_do_not_depend_on_place():
    import pyarrow as pa

    from arbolytics.llm.words import word_hashes

    long = word_hashes(pa.array(["x" * 3_000_000 + " same words", None, "same  words", "SAME words"]))
    assert long.cuts.tolist() == [0, 3, 3, 5, 7]
    assert long.hashes[1:3].tolist() == long.hashes[3:5].tolist() != long.hashes[5:].tolist()
    folded = word_hashes(pa.array(["SAME words"]), fold=True)
    assert folded.hashes.tolist() == long.hashes[3:5].tolist()


def test_packed_blobs():
    import numpy as np

    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2))
    side = np.arange(len(keys), dtype=np.uint32)
    rows = list(packed.send(7, 13, keys, side))
    merged = packed.merge([b for _, _, b in rows])
    assert (merged[0] == keys).all() and (merged[1] == side).all() and {g for _, g, _ in rows} == {7}
    assert packed.merge([])[0].tolist() == []


def brute_classes(rows, length, parts, whole):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, t in rows:
        ws = [w.decode() for w in (t or "").translate(low).encode().split()]
        sets.append({tuple(ws[i:i + length]) for i in range(max(1, len(ws) - length + 1))} if ws else set())
    seen = list(range(len(rows)))

    def root(i):
        while seen[i] != i:
            i = seen[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and whole * len(sets[i] & sets[j]) >= parts * len(sets[i] | sets[j]):
            seen[root(i)] = root(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((d, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("length,parts", [(3, 90), (5, 80), (1, 60)])
def test_classes(docs, words, length, parts):
    pick, rows = random.Random(length), []
    for family in range(6):
        base = words(pick.randrange(1, 90), family)
        for _ in range(10):
            text = list(base)
            for _ in range(pick.randrange(5)):
                text[pick.randrange(len(text))] = f"new{pick.randrange(10)}"
            rows.append((pick.randrange(70), " ".join(text)))
    rows += [(100, None), (101, ""), (102, "one two"), (103, "ONE  two"), (None, "one two"), (None, "lonely text here today ok"), (104, " \n")]
    got = N.ngram_components(docs(rows), length, parts).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == brute_classes(rows, length, parts, 100)


def test_chain_of_links_is_one_class(docs, words):
    base = words(60, 1, of=10_000)
    rows = [(d, " ".join(base[d:d + 40])) for d in range(20)]  # each is linked to the next ones only
    got = N.ngram_components(docs(rows), 3, 90).collect()
    assert {r.component_id for r in got} == {0}


def test_first_of_each_class_stays(docs, words):
    text = " ".join(words(40, 1))
    rows = [(5, text), (3, text), (3, text), (9, None), (9, None), (7, "alone"), (None, "x y"), (None, "x y")]
    df = docs([(d, t, 1, 2, "l", 3, 4) for d, t in rows], CLASHING)
    kept = N.keep_first(df, N.ngram_components(df))
    assert kept.columns == df.columns
    assert sorted((tuple(r)[:2] for r in kept.collect()), key=repr) == sorted(
        [(3, text), (9, None), (9, None), (7, "alone"), (None, "x y")], key=repr)


def test_no_documents(docs):
    assert N.ngram_components(docs([])).count() == 0
    assert N.ngram_components(docs([(1, None)])).select("doc_id", "n_shingles", "component_id").collect() == [(1, 0, 1)]
    assert L.line_dedup(docs([])).count() == 0


def test_components_of_long_paths(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (101, 100)]
    got = components(spark.createDataFrame(links, "u long, v long"))
    assert {tuple(r) for r in got.collect()} == {(i, 0) for i in range(41)} | {(i, 100) for i in (100, 101, 102)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return row[-1]


def brute_lines(rows, threshold):
    first = {}
    for d, x in sorted(rows):
        for i, line in enumerate(x.split("\n")):
            if line.strip():
                first.setdefault(line, (d, i))
    order, near = sorted(first, key=first.get), set()
    least = (threshold + 1) * L.LEAST_SEGMENT
    for k, line in enumerate(order):
        if len(line) >= least and any(len(m) >= least and abs(len(m) - len(line)) <= threshold and edits(line, m) <= threshold
                                      for m in order[:k]):
            near.add(line)
    return {d: "\n".join(line for i, line in enumerate(x.split("\n"))
                         if not line.strip() or first[line] == (d, i) and line not in near) for d, x in rows}


@pytest.mark.parametrize("threshold", [1, 2])
def test_lines(docs, threshold):
    pick = random.Random(threshold)
    base = ["".join(pick.choice("abcé ") for _ in range(pick.randrange(20, 60))) for _ in range(10)]

    def changed(line):
        line = list(line)
        for _ in range(pick.randrange(4)):
            at, kind = pick.randrange(len(line)), pick.random()
            line[at:at + (kind > 0.3)] = pick.choice(["", "x", "é"]) if kind < 0.7 else pick.choice("abc")
        return "".join(line)

    rows = [(d, "\n".join(pick.choice([changed(pick.choice(base)), pick.choice(base), "", "short"]) for _ in range(pick.randrange(1, 8))))
            for d in range(50)]
    got = {r.doc_id: r.text for r in L.line_dedup(docs(rows), threshold).collect()}
    assert got == brute_lines(rows, threshold)


def test_lines_of_odd_rows(docs):
    line = "a line that is long enough to be compared by segments"
    rows = [(1, line), (1, line), (2, None), (3, ""), (None, line), (4, "x\n\n x"), (5, line[:-1] + "!")]
    df = docs([(d, t, 1, 2, "l", 3, 4) for d, t in rows], CLASHING)
    got = L.line_dedup(df)
    assert got.columns == [c for c in df.columns if c != "n_removed"] + ["n_lines", "n_removed"]
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()), key=repr) == sorted(
        [(1, line, 1, 0), (1, line, 1, 0), (2, None, 0, 0), (3, "", 1, 0), (None, "", 1, 1), (4, "x\n\n x", 3, 0), (5, "", 1, 1)], key=repr)


def near_by_brute_force(first, edits_of, least):
    """Lines with an earlier line within the edits allowed, by all pairs."""
    order, near = sorted(first, key=first.get), set()
    for k, b in enumerate(order):
        for a in order[:k]:
            most = edits_of(min(len(a), len(b)))
            if abs(len(a) - len(b)) <= most and all(len(x) >= (edits_of(len(x)) + 1) * least for x in (a, b)) and edits(a, b) <= most:
                near.add(b)
                break
    return near


def changing_lines(pick, words_of, families, copies):
    """Texts with lines that differ from a base line by some words or letters, anywhere in the line."""
    letters = "abcdefghijklmnopqrstuvwxyzé"
    word = lambda: "".join(pick.choices(letters, k=pick.randrange(2, 11)))
    rows = []
    for _ in range(families):
        base = [word() for _ in range(words_of())]
        for _ in range(copies):
            line = list(base)
            for _ in range(pick.choice([0, 1, 1, 2, 3, len(base) // 8])):
                at, kind = pick.randrange(len(line)), pick.random()
                line[at:at + (kind > 0.15)] = [] if kind > 0.85 else [word()] if kind > 0.3 else [line[at] + "x"] if kind > 0.15 else [word()]
            rows.append((len(rows), " ".join(line)))
    pick.shuffle(rows)
    return [(d, t) for d, (_, t) in enumerate(rows)]


def first_places(rows):
    first = {}
    for d, text in rows:
        for i, line in enumerate(text.split("\n")):
            if line.strip():
                first.setdefault(line, (d, i))
    return first


def test_short_lines_by_length_are_found_completely(docs):
    pick = random.Random(11)
    rows = changing_lines(pick, lambda: pick.randrange(4, 11), 14, 4)
    for d, t in list(rows):
        for _ in range(2):
            line = list(t)
            for _ in range(pick.randrange(1, 5)):
                at, kind = pick.randrange(len(line)), pick.random()
                line[at:at + (kind > 0.3)] = pick.choice(["", "y"]) if kind > 0.3 else "z"
            rows.append((len(rows), "".join(line)))
    rows += [(900, "x" * 50 + "\n" + "x" * 48 + "yy"), (901, "x" * 79), (902, "x" * 82)]
    rows = [(d, t) for d, t in rows if len(t) < 78 or d >= 900]
    first = first_places(rows)
    near = near_by_brute_force(first, lambda n: max(1, n // 20), L.LEAST_SEGMENT)
    got = {r.doc_id: r.text for r in L.line_dedup(docs(rows), chars_per_edit=20).collect()}
    assert got == {d: "\n".join(x for i, x in enumerate(t.split("\n")) if first[x] == (d, i) and x not in near) for d, t in rows}
    assert len(near) > 15


def test_long_lines_by_length(docs):
    """No line goes without an earlier one in its edits, and nine in ten that have one go, in families of lines near to one another."""
    pick = random.Random(12)
    rows = changing_lines(pick, lambda: pick.randrange(18, 70), 12, 12)
    first = first_places(rows)
    near = near_by_brute_force(first, lambda n: max(1, n // 20), L.LEAST_SEGMENT)
    got = {r.doc_id: r.text for r in L.line_dedup(docs(rows), chars_per_edit=20).collect()}
    gone = {t for d, t in rows if not got[d] and first[t] == (d, 0)}
    assert gone <= near and len(near) > 60 and len(gone) >= 0.9 * len(near)
    assert all(not got[d] for d, t in rows if first[t] != (d, 0))


def test_long_lines_without_blanks(docs):
    pick = random.Random(13)
    base = ["".join(pick.choices("日本語文字列検索単語文章行長短変更編集距離", k=200)) for _ in range(4)]
    rows = [(d, base[d % 4][:50 + d] + "新" * (d % 3) + base[d % 4][50 + d + d % 3:]) for d in range(24)]
    first = first_places(rows)
    near = near_by_brute_force(first, lambda n: max(1, n // 20), L.LEAST_SEGMENT)
    got = {r.doc_id: r.text for r in L.line_dedup(docs(rows), chars_per_edit=20).collect()}
    gone = {t for d, t in rows if not got[d] and first[t] == (d, 0)}
    assert gone <= near and len(gone) >= 0.9 * len(near) > 0


def test_long_lines_with_spread_edits_are_found_completely(docs):
    """Edits at even distances leave no long part of a line as it was."""
    pick = random.Random(15)
    rows = []
    for k in range(30):
        n = pick.randrange(80, 400) if k else 1800
        line = "".join(pick.choices("abcdefghijklmnopqrstuvwxyz ", k=n - 2)) + "ab"
        most = (n - n // 40) // 20
        other, start = list(line), pick.randrange(10, 16)
        for k in range(most):
            at = start + k * (n - start) // most
            other[at] = pick.choice(["", "#", other[at] + "#"])
        rows += [(len(rows), line), (len(rows) + 1, "".join(other))]
    pick.shuffle(rows)
    rows = [(d, t) for d, (_, t) in enumerate(rows)]
    first = first_places(rows)
    near = near_by_brute_force(first, lambda n: max(1, n // 20), L.LEAST_SEGMENT)
    got = {r.doc_id: r.text for r in L.line_dedup(docs(rows), chars_per_edit=20).collect()}
    assert {t for d, t in rows if not got[d]} == near and len(near) > 25


def test_long_lines_are_found_in_parts_by_length(docs, monkeypatch):
    """Pairs whose lengths lie in different parts are found as well, and a line of many pieces like any other."""
    pick = random.Random(16)
    rows = []
    for n in [*range(80, 400, 5), 13_000]:
        line = "".join(pick.choices("abcdefghijklmnopqrstuvwxyz ", k=n - 1)) + "a"
        most = (n - n // 20) // 20
        gone = {13 + k * (n - 13) // most for k in range(most)}
        rows += [line, "".join(c for i, c in enumerate(line) if i not in gone)]
    pick.shuffle(rows)
    rows = list(enumerate(rows))
    monkeypatch.setattr(L, "LEAST_SLICE", 1)
    lengths = [len(t) for _, t in rows]
    parts = L.length_slices(docs(rows).selectExpr("char_length(text) AS n"))
    assert len(parts) > 5 and all(sum(low <= n <= high for low, high in parts) == 1 for n in lengths)
    got = {r.doc_id: r.text for r in L.line_dedup(docs(rows), chars_per_edit=20).collect()}
    assert sum(not t for t in got.values()) == len(rows) // 2


def test_nothing_but_the_result_stays(spark, docs, scope):
    """The tables staged on the way are gone when the result is read, and the session is as it was."""
    import os

    from arbolytics.session import SHUFFLE_CLEANUP

    pick = random.Random(17)
    rows = changing_lines(pick, lambda: pick.randrange(4, 60), 10, 4)
    for cpe in (None, 20):
        before, was = set(os.listdir(scope) if os.path.exists(scope) else []), spark.conf.get(SHUFFLE_CLEANUP, None)
        assert L.line_dedup(docs(rows), chars_per_edit=cpe).filter("n_removed > 0").count() > 0
        assert len(set(os.listdir(scope)) - before) == 1 and spark.conf.get(SHUFFLE_CLEANUP, None) == was


def test_very_many_lines_of_one_list(spark, docs):
    """Far lines with a common part, and near copies of a line that is not there, make pairs in proportion to the lines."""
    import duckdb

    pick = random.Random(14)
    word = lambda: "".join(pick.choices("abcdefghij", k=6))
    common = " ".join(word() for _ in range(20))
    rows = [(d, common + " " + " ".join(word() for _ in range(20))) for d in range(200)]
    base = [word() for _ in range(60)]
    for d in range(200):
        line = list(base)
        for _ in range(pick.randrange(1, 6)):
            line[pick.randrange(60)] = word()
        rows.append((1000 + d, " ".join(line)))
    made = []
    real = L.verified

    def counting(pairs, *rest):
        out = L.stage(pairs, "counted")
        made.append(out.count())
        return real(out, *rest)

    L.verified = counting
    try:
        got = {r.doc_id: r.text for r in L.line_dedup(docs(rows), chars_per_edit=20).collect()}
    finally:
        L.verified = real
    assert sum(made) < (L.CENTRAL + 4) * len(rows)  # all pairs are 50 times as many
    con = duckdb.connect()
    con.execute("CREATE TABLE l (d INT, t VARCHAR)")
    con.executemany("INSERT INTO l VALUES (?, ?)", rows)
    near = {d for d, in con.execute("SELECT DISTINCT b.d FROM l a JOIN l b ON a.d < b.d AND "
                                    "levenshtein(a.t, b.t) <= greatest(1, least(len(a.t), len(b.t)) // 20)").fetchall()}
    gone = {d for d, t in rows if not got[d]}
    assert gone <= near and len(gone) >= 0.9 * len(near) > 80


def test_columns_of_any_name_pass(docs):
    line = "a line that is long enough to be compared by segments"
    df = docs([(1, line, 5, "r", 7, 8, 9), (2, line, 6, "s", 7, 8, 9)], "doc_id long, text string, _doc int, _row string, _dropped int, all int, row int")
    for cpe in (None, 20):
        got = L.line_dedup(df, chars_per_edit=cpe)
        assert got.columns == [*df.columns, "n_lines", "n_removed"]
        assert sorted(map(tuple, got.collect())) == [(1, line, 5, "r", 7, 8, 9, 1, 0), (2, "", 6, "s", 7, 8, 9, 1, 1)]
    assert L.line_dedup(docs([(1, "abc"), (2, "abd")]), least_segment=0).filter("n_removed = 1").count() == 1
