"""Alignment of two tokenizers' tokens over the same bytes, and which token pairs meet how often.

Tokens of both vocabularies that end at the same byte cut a text into groups; tokens whose bytes overlap are linked.

Very long texts are cut into byte ranges that tasks encode by themselves. A range yields a fragment: the tokens up to its first
common end (open prefix), closed groups, and the tokens after its last common end (open suffix). Two neighbouring
fragments make one: the suffix of the left and the prefix of the right are one closed group. This is associative, so
a tree of Spark rounds composes the fragments of a text in any bracketing; only the open ends travel, closed groups
stay rows of their own, numbered by the range in which they end.

How many documents hold a linked pair is counted by packs: a pack is some megabytes of documents of one task. It sends
each of its pairs once with its number of documents, and gets each count back once, so a pair that all
documents hold costs a row for each pack. What the pack keeps meanwhile is a compressed sparse table of its documents' pairs.

No token crosses a single blank between visible characters, so a text is the composition of its words' alignments, and a word is
encoded and aligned once while a bounded cache keeps it.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from arbolytics.llm import packed
from arbolytics.llm.byte_bpe import byte_characters
from arbolytics.llm.chunk_encoder import WIDE_BLANK
from arbolytics.llm.common import bare, batch_slices, pieces
from arbolytics.session import stage

#: Texts of more characters are cut into ranges of about so many.
RANGE_CHARS = 1 << 16
#: Fragments composed in one task of a round.
FAN = 16
#: Bytes of text in a pack, about.
PACK_BYTES = 2 << 20
#: Words that the library gets as one text, as a call for each costs more than its work.
JOINED = 2_000
#: The cache of words is emptied beyond so many; that changes no result.
MOST_KNOWN = 400_000
SEPARATORS = np.frombuffer(b",|;", np.uint8)


class Spelling:
    """Byte strings by id, in one array."""

    def __init__(self, strings: list[bytes]):
        self.widths = self.starts = np.zeros(0, np.int64)
        self.data = np.zeros(0, np.uint8)
        self.add(strings)

    def add(self, strings: list[bytes]) -> None:
        widths = np.array([len(s) for s in strings], np.int64)
        self.starts = np.concatenate([self.starts, len(self.data) + np.cumsum(widths) - widths])
        self.widths = np.concatenate([self.widths, widths])
        self.data = np.concatenate([self.data, np.frombuffer(b"".join(strings), np.uint8)])

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids, one after another."""
        widths = self.widths[ids]
        ends = np.cumsum(widths)
        return self.data[np.repeat(self.starts[ids] - ends + widths, widths) + np.arange(ends[-1] if len(ends) else 0)]


@dataclass
class Vocabulary:
    """Ids of texts that begin with a blank, and the bytes and decimal digits of each id."""

    encode: Callable[[list[str]], list[list[int]]]
    spelling: Spelling
    size: int
    digits: Spelling = field(init=False)

    def __post_init__(self):
        self.digits = Spelling([b"%d," % i for i in range(self.size)])


def byte_level(path: str) -> Vocabulary:
    """A byte-level vocabulary of the tokenizers library; strings of special tokens are plain text."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    byte = {c: b for b, c in enumerate(byte_characters())}
    names = {i: t for t, i in library.get_vocab(with_added_tokens=True).items()}
    strings = [bytes(byte[c] for c in names.get(i, "")) for i in range(max(names) + 1)]
    spelling = Spelling(strings)
    return Vocabulary(lambda texts: [x.ids for x in library.encode_batch_fast(texts, add_special_tokens=False)], spelling, len(strings))


def pieces_of(path: str) -> Vocabulary:
    """A sentencepiece vocabulary. The library puts a blank before each text, so the text's own is left out."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=path)
    strings = [bytes([int(p[3:5], 16)]) if library.is_byte(i) else p.replace("▁", " ").encode()
               for i, p in enumerate(map(library.id_to_piece, range(library.get_piece_size())))]
    spelling = Spelling(strings)
    return Vocabulary(lambda texts: library.encode([t[1:] for t in texts], num_threads=1), spelling, len(strings))


@lru_cache(maxsize=2)
def vocabularies(path_a: str, path_b: str) -> tuple[Vocabulary, Vocabulary]:
    return byte_level(path_a), pieces_of(path_b)


@dataclass
class Tokens:
    """Tokens of consecutive runs by both vocabularies; those of run r are ids[cuts[r]:cuts[r + 1]]."""

    a: np.ndarray
    b: np.ndarray
    cuts_a: np.ndarray
    cuts_b: np.ndarray

    @classmethod
    def of(cls, a: list[list[int]], b: list[list[int]]) -> "Tokens":
        flat = lambda x: np.concatenate([np.array(y, np.int64) for y in x]) if x else np.empty(0, np.int64)
        cuts = lambda x: np.cumsum([0, *map(len, x)])
        return cls(flat(a), flat(b), cuts(a), cuts(b))


def encoded(texts: list[str], va: Vocabulary, vb: Vocabulary) -> tuple[np.ndarray, Tokens]:
    """Places of the texts that have tokens, and their tokens.

    An empty text has none, nor has one whose bytes with the blank before it are not those of its tokens on both sides.
    """
    places = [i for i, t in enumerate(texts) if t]
    blanked = [" " + texts[i] for i in places]
    a, b, raw = va.encode(blanked), vb.encode(blanked), [t.encode("utf-8", "surrogatepass") for t in blanked]
    fits = [r for r, x in enumerate(raw) if va.spelling.widths[a[r]].sum() == len(x) == vb.spelling.widths[b[r]].sum()]
    whole, ends = np.frombuffer(b"".join(raw[r] for r in fits), np.uint8), np.cumsum([len(raw[r]) for r in fits])
    wrong = set()
    for ids, v in ((a, va), (b, vb)):
        spelled = v.spelling(np.concatenate([np.array(ids[r], np.int64) for r in fits])) if fits else whole
        wrong |= set(np.searchsorted(ends, np.flatnonzero(spelled != whole), "right").tolist())
    fits = [r for k, r in enumerate(fits) if k not in wrong]
    return np.array([places[r] for r in fits], np.int64), Tokens.of([a[r] for r in fits], [b[r] for r in fits])


def _common(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """Which of the ends on the left are also on the right (both ascend)."""
    return ends_b[np.minimum(np.searchsorted(ends_b, ends_a), len(ends_b) - 1)] == ends_a if len(ends_b) else np.zeros(len(ends_a), bool)


@dataclass
class Aligned:
    """What the tokens of runs make: groups of each run in writing, and links."""

    n_groups: np.ndarray
    n_links: np.ndarray
    written: list[memoryview]
    run: np.ndarray  # of each distinct (run, pair)
    pair: np.ndarray
    times: np.ndarray


def aligned(tokens: Tokens, va: Vocabulary, vb: Vocabulary) -> Aligned:
    """Groups and links of runs that begin and end with both vocabularies at the same bytes.

    A group is written as ids of a by commas, a bar, and ids of b; groups are parted by semicolons.
    """
    a, b, runs = tokens.a, tokens.b, len(tokens.cuts_a) - 1
    ends_a, ends_b = np.cumsum(va.spelling.widths[a]), np.cumsum(vb.spelling.widths[b])
    run_ends = ends_a[tokens.cuts_a[1:] - 1] if runs else np.empty(0, np.int64)
    closing_a, closing_b = _common(ends_a, ends_b), _common(ends_b, ends_a)
    closed = ends_a[closing_a]
    per_run = lambda ends: np.diff(np.searchsorted(ends, run_ends, "right"), prepend=0)

    # Each piece between neighbouring ends of either side lies in one token of a and one of b: a link.
    edges = np.sort(np.concatenate([ends_a, ends_b[~closing_b]]), kind="stable")
    pair = a[np.searchsorted(ends_a, edges)] * vb.size + b[np.searchsorted(ends_b, edges)]
    n_links = per_run(edges)
    keyed, times = np.unique(np.repeat(np.arange(runs), n_links) * (va.size * vb.size) + pair, return_counts=True)

    # Ids in writing order: those of a, then of b, group by group.
    group_a, group_b = np.searchsorted(closed, ends_a), np.searchsorted(closed, ends_b)
    first_a, last_b = np.searchsorted(group_b, group_a), np.searchsorted(group_a, group_b, "right")
    at_a, at_b = np.arange(len(a)) + first_a, np.arange(len(b)) + last_b
    widths, marks = np.empty(len(a) + len(b), np.int64), np.zeros(len(a) + len(b), np.int64)
    widths[at_a], widths[at_b] = va.digits.widths[a], vb.digits.widths[b]
    marks[at_a], marks[at_b] = closing_a, 2 * closing_b
    ends = np.cumsum(widths)
    out = np.empty(ends[-1] if len(ends) else 0, np.uint8)
    for at, ids, digits in ((at_a, a, va.digits), (at_b, b, vb.digits)):
        sizes = widths[at]
        place = np.repeat(ends[at] - sizes - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        out[place] = digits(ids)
    out[ends - 1] = SEPARATORS[marks]
    stops = ends[tokens.cuts_a[1:] + tokens.cuts_b[1:] - 1].tolist() if runs else []
    view = memoryview(out)
    written = [view[s:e - 1] for s, e in zip([0, *stops[:-1]], stops, strict=True)] if runs else []
    return Aligned(per_run(closed), n_links, written, keyed // (va.size * vb.size), keyed % (va.size * vb.size), times)


def words_of(texts: list[str]) -> Iterator[tuple[list[int], pa.ListArray]]:
    """Places of texts, and the words that their tokens do not cross; white space beyond single blanks stays in a word."""
    column = pa.array(texts, pa.string())
    odd = pc.or_(pc.match_substring_regex(column, "^ |" + WIDE_BLANK), pc.match_substring(column, "▁"))
    for places, cut in ((pc.indices_nonzero(pc.invert(odd)), lambda x: pc.split_pattern(x, " ")),
                        (pc.indices_nonzero(odd), lambda x: pa.array([_CUT.split(t) for t in x.to_pylist()], pa.list_(pa.string())))):
        if len(places):
            yield places.to_pylist(), cut(column.take(places))


_CUT = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")


@dataclass
class Sums:
    """Figures of texts by their places in a list; ``run``, ``pair`` and ``times`` are those of their distinct pairs."""

    places: list[int]
    numbers: np.ndarray  # n_a, n_b, n_groups and n_links of each
    digests: list[str]
    run: np.ndarray
    pair: np.ndarray
    times: np.ndarray


class WordTable:
    """Alignments of words, each made once while it is known."""

    def __init__(self, va: Vocabulary, vb: Vocabulary):
        self.va, self.vb = va, vb
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.numbers = np.zeros((0, 4), np.int64)
        self.good = np.zeros(0, bool)
        self.written = Spelling([])
        self.pairs_end = np.zeros(0, np.int64)
        self.pair = self.times = np.zeros(0, np.int64)

    def _joined(self, words: list[str]) -> tuple[np.ndarray, Tokens]:
        """Places of the words with tokens, and these: encoded as one text if that keeps all bytes, else one by one."""
        ends = np.cumsum([len(w.encode("utf-8", "surrogatepass")) + 1 for w in words])
        if "" not in words:
            good, whole = encoded([" ".join(words)], self.va, self.vb)
            if len(good):
                cuts = []
                for ids, v in ((whole.a, self.va), (whole.b, self.vb)):
                    reached = np.cumsum(v.spelling.widths[ids])
                    at = np.searchsorted(reached, ends)
                    if (reached[at] != ends).any():
                        break
                    cuts.append(np.concatenate([[0], at + 1]))
                else:
                    return np.arange(len(words)), Tokens(whole.a, whole.b, *cuts)
        # An empty word is the blank that the text begins with.
        a, b = (v.encode([" " + w for w in words]) for v in (self.va, self.vb))
        kept = [i for i, w in enumerate(words) if all(
            v.spelling(np.array(ids[i], np.int64)).tobytes() == (" " + w).encode("utf-8", "surrogatepass") for ids, v in ((a, self.va), (b, self.vb)))]
        return np.array(kept, np.int64), Tokens.of([a[i] for i in kept], [b[i] for i in kept])

    def _learn(self, words: list[str]) -> None:
        numbers, good, written, pair, times, counts = [self.numbers], [self.good], [], [self.pair], [self.times], []
        for at in range(0, len(words), JOINED):
            part = words[at:at + JOINED]
            places, tokens = self._joined(part)
            found = aligned(tokens, self.va, self.vb)
            rows, ok, per = np.zeros((len(part), 4), np.int64), np.zeros(len(part), bool), np.zeros(len(part), np.int64)
            rows[places] = np.stack([np.diff(tokens.cuts_a), np.diff(tokens.cuts_b), found.n_groups, found.n_links], 1)
            ok[places], per[places] = True, np.bincount(found.run, minlength=len(places))
            texts = [b""] * len(part)
            for i, x in zip(places.tolist(), found.written, strict=True):
                texts[i] = bytes(x) + b";"
            written += texts
            numbers.append(rows), good.append(ok), counts.append(per), pair.append(found.pair), times.append(found.times)
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words)), strict=True))
        self.numbers, self.good, self.pair, self.times = map(np.concatenate, (numbers, good, pair, times))
        self.pairs_end = np.concatenate([self.pairs_end, np.cumsum(np.concatenate(counts)) + (self.pairs_end[-1] if len(self.pairs_end) else 0)])
        self.written.add(written)

    def __call__(self, places: list[int], lists: pa.ListArray) -> Sums:
        """The figures of the texts at ``places`` whose words are given; texts with a bad word are left out."""
        if len(self.known) > MOST_KNOWN:
            self._clear()
        coded = lists.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = [w for w in distinct if w not in self.known]
        if new:
            self._learn(new)
        of_distinct = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        words, cuts = of_distinct[coded.indices.to_numpy()], lists.offsets.to_numpy() - lists.offsets[0].as_py()
        total = lambda x: (y := np.concatenate([np.zeros((1, *x.shape[1:]), np.int64), np.cumsum(x, 0)]))[cuts[1:]] - y[cuts[:-1]]
        kept = total(~self.good[words]) == 0
        digests = [hashlib.sha256(self.written(words[a:b])[:-1]).hexdigest() if k else ""
                   for a, b, k in zip(cuts[:-1].tolist(), cuts[1:].tolist(), kept.tolist(), strict=True)]
        run = np.repeat(np.cumsum(kept) - 1, np.diff(cuts))[np.repeat(kept, np.diff(cuts))]
        words_kept = words[np.repeat(kept, np.diff(cuts))]
        numbers = total(self.numbers[words])[kept]
        # Words of each text once, then their pairs.
        keyed, often = np.unique(run * len(self.known) + words_kept, return_counts=True)
        run, word = np.divmod(keyed, len(self.known))
        size = np.diff(self.pairs_end, prepend=0)[word]
        at = np.repeat(self.pairs_end[word] - np.cumsum(size), size) + np.arange(size.sum())
        pairs = self.va.size * self.vb.size
        keyed, order = np.unique(np.repeat(run, size) * pairs + self.pair[at], return_inverse=True)
        times = np.bincount(order, np.repeat(often, size) * self.times[at], len(keyed)).astype(np.int64)
        return Sums([p for p, k in zip(places, kept.tolist(), strict=True) if k], numbers, [d for d, k in zip(digests, kept.tolist(), strict=True) if k],
                    keyed // pairs, keyed % pairs, times)


@lru_cache(maxsize=1)
def word_table(path_a: str, path_b: str) -> WordTable:
    return WordTable(*vocabularies(path_a, path_b))


@dataclass
class Fragment:
    """Tokens of neighbouring byte ranges: those up to the first common end, closed runs between, those after the last one.

    ``first`` is the number of the range with the first common end, None if there is none; all tokens are then in the
    prefix. ``closed`` lists (range, ids of a, ids of b) of the groups that composing closed.
    """

    first: int | None
    prefix: tuple[list[int], list[int]]
    suffix: tuple[list[int], list[int]]
    closed: list[tuple[int, list[int], list[int]]] = field(default_factory=list)


def compose(left: Fragment, right: Fragment) -> Fragment:
    """The fragment of two neighbouring ones (associative)."""
    join = lambda x, y: (x[0] + y[0], x[1] + y[1])
    if left.first is None:
        return Fragment(right.first, join(left.prefix, right.prefix), right.suffix, left.closed + right.closed)
    if right.first is None:
        return Fragment(left.first, left.prefix, join(left.suffix, right.prefix), left.closed + right.closed)
    return Fragment(left.first, left.prefix, right.suffix, left.closed + [(right.first, *join(left.suffix, right.prefix))] + right.closed)


def fragment_of(number: int, a: list[int], ends_a: np.ndarray, b: list[int], ends_b: np.ndarray) -> tuple[Fragment, tuple[list[int], list[int]]]:
    """The fragment of a byte range, and its closed run. The tokens are those that end in the range."""
    shared = ends_a[_common(ends_a, ends_b)]
    if not len(shared):
        return Fragment(None, (a, b), ([], [])), ([], [])
    (i, k), (j, m) = (np.searchsorted(ends, [shared[0], shared[-1]], "right").tolist() for ends in (ends_a, ends_b))
    return Fragment(number, (a[:i], b[:j]), (a[k:], b[m:])), (a[i:k], b[j:m])


def ranges(text: str, size: int) -> Iterator[str]:
    """The text cut at single blanks between visible characters, about every ``size`` characters, less the blanks at the cuts.

    Neither vocabulary has tokens across such a blank, and both put a blank before a text, so the tokens of the parts
    are those of the whole. A stretch without such a blank is one part.
    """
    start = 0
    while True:
        at = text.find(" ", start + size)
        while 0 < at < len(text) - 1 and (text[at - 1].isspace() or text[at + 1].isspace() or text[at + 1] == "▁"
                                          or text[at - 1] == "▁" or unicodedata.combining(text[at + 1])):
            at = text.find(" ", at + 1)
        if at <= 0 or at >= len(text) - 1:
            yield text[start:]
            return
        yield text[start:at]
        start = at + 1


IDS = "a array<int>, b array<int>"
FRAGMENTS = f"key long, place long, kind string, first long, {IDS}, suffix_a array<int>, suffix_b array<int>"
_ints = pa.list_(pa.int32())
_FRAGMENTS = pa.schema([("key", pa.int64()), ("place", pa.int64()), ("kind", pa.string()), ("first", pa.int64()),
                        ("a", _ints), ("b", _ints), ("suffix_a", _ints), ("suffix_b", _ints)])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _fragment_row(key: int, place: int, f: Fragment) -> tuple:
    return (key, place, "open", f.first, *f.prefix, *f.suffix)


def _run_row(key: int, place: int, a, b) -> tuple:
    return (key, place, "run", None, a, b, None, None)


def cut_texts(long: DataFrame) -> DataFrame:
    """key, place and text of the byte ranges of long texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.int64()), ("place", pa.int64()), ("text", pa.string())])
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text"), strict=True):
                for place, part in enumerate(ranges(text.as_py(), RANGE_CHARS)):
                    yield _batch([(key, place, part)], schema)

    return long.select("key", "text").mapInArrow(run, "key long, place long, text string")


def fragments(parts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """For each byte range: its open ends (``open``), its closed run (``run``), or ``bad`` if its bytes are not kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        va, vb = vocabularies(path_a, path_b)
        for batch in (part for whole in batches for part in batch_slices(whole, PACK_BYTES)):
            keys, places, texts = (batch.column(c).to_pylist() for c in ("key", "place", "text"))
            good, tokens = encoded(texts, va, vb)
            rows = [(keys[i], places[i], "bad", *[None] * 5) for i in set(range(len(texts))) - set(good.tolist())]
            for r, i in enumerate(good.tolist()):
                a, b = tokens.a[tokens.cuts_a[r]:tokens.cuts_a[r + 1]], tokens.b[tokens.cuts_b[r]:tokens.cuts_b[r + 1]]
                ends = np.cumsum(va.spelling.widths[a]), np.cumsum(vb.spelling.widths[b])
                fragment, inner = fragment_of(places[i], a.tolist(), ends[0], b.tolist(), ends[1])
                rows.append(_fragment_row(keys[i], places[i], fragment))
                if inner[0]:
                    # Before the closed run of a range stands the group that ends first in it: even and odd places.
                    rows.append(_run_row(keys[i], 2 * places[i] + 1, *inner))
            yield _batch(rows, _FRAGMENTS)

    return parts.mapInArrow(run, FRAGMENTS)


def _composed(table: pa.Table) -> pa.Table:
    """The fragments of a key's neighbouring places as one, and the groups that this closes."""
    rows = sorted(table.to_pylist(), key=lambda r: r["place"])
    whole = None
    for r in rows:
        f = Fragment(r["first"], (r["a"], r["b"]), (r["suffix_a"], r["suffix_b"]))
        whole = f if whole is None else compose(whole, f)
    key = rows[0]["key"]
    out = [_fragment_row(key, rows[0]["place"] // FAN, whole), *[_run_row(key, 2 * c, a, b) for c, a, b in whole.closed]]
    return pa.Table.from_batches([_batch(out, _FRAGMENTS)])


def closed_runs(found: DataFrame) -> DataFrame:
    """key, place, a and b of all closed runs of the texts whose fragments are given, in the order of their places.

    Each round composes ``FAN`` neighbours, until a text is one fragment. Its prefix then begins at the text's first byte and is closed.
    """
    runs = found.filter("kind = 'run'")
    open_ = found.filter("kind = 'open'")
    while True:
        last = open_.agg(F.max("place")).first()[0]
        if not last:
            break
        step = stage(open_.groupBy("key", F.floor(F.col("place") / FAN).alias("at")).applyInArrow(_composed, FRAGMENTS), "align-round")
        runs, open_ = runs.union(step.filter("kind = 'run'")), step.filter("kind = 'open'")
    # A text that ends with both sides at one byte has no suffix left.
    ends = open_.filter("first is not null").select("key", (2 * F.col("first")).alias("place"), "a", "b")
    return runs.select("key", "place", "a", "b").union(ends)


MEASURED = ("pack long, at int, key long, place long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
            "written binary, pairs array<long>, documents array<long>, blob binary")
_longs = pa.list_(pa.int64())
_MEASURED = pa.schema([("pack", pa.int64()), ("at", pa.int32()), ("key", pa.int64()), ("place", pa.int64()), ("doc_id", pa.int64()),
                       ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
                       ("written", pa.binary()), ("pairs", _longs), ("documents", _longs), ("blob", pa.binary())])


class Packs:
    """Numbers of a task's packs; ``odd`` keeps those of two jobs apart."""

    def __init__(self, odd: int):
        self.next = (TaskContext.get().partitionId() << 32) + odd

    def __call__(self) -> int:
        self.next += 2
        return self.next - 2


def _pack_row(pack: int, found: Aligned | Sums) -> tuple:
    pairs, at, documents = np.unique(found.pair, return_inverse=True, return_counts=True)
    blob = packed.pack((found.run * len(pairs) + at).astype(np.uint64), found.times.astype(np.uint32)) if len(pairs) else None
    return (pack, -1, *[None] * 9, pairs, documents, blob)


def measured_texts(short: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row for each text with its figures, and one (``at`` -1) for each pack with its pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, number = word_table(path_a, path_b), Packs(0)
        for batch in (part for whole in batches for part in batch_slices(whole, PACK_BYTES)):
            ids, texts = batch.column("doc_id").to_pylist(), [x or "" for x in batch.column("text").to_pylist()]
            left = set(range(len(ids)))
            full = [i for i in range(len(ids)) if texts[i]]
            for places, words in words_of([texts[i] for i in full]):
                found, pack = table([full[p] for p in places], words), number()
                left -= set(found.places)
                yield _batch([*((pack, r, None, None, ids[i], *numbers, digest, *[None] * 4) for r, (i, numbers, digest) in enumerate(
                    zip(found.places, found.numbers.tolist(), found.digests, strict=True))), _pack_row(pack, found)], _MEASURED)
            # Rows without tokens go with a pack of their own.
            pack = number()
            yield _batch([*((pack, None, None, None, ids[i], 0, 0, 0, 0, "", *[None] * 4) for i in sorted(left)), _pack_row(pack, _NOTHING)], _MEASURED)

    return short.mapInArrow(run, MEASURED)


_NOTHING = Sums([], np.zeros((0, 4), np.int64), [], *[np.zeros(0, np.int64)] * 3)


def measured_runs(runs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """As ``measured_texts`` for closed runs; each row keeps its groups in writing and its own pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        va, vb = vocabularies(path_a, path_b)
        number = Packs(1)
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch, pack = whole.slice(at, 64), number()
                keys, places = batch.column("key").to_pylist(), batch.column("place").to_pylist()
                tokens = Tokens.of(*[[x.values.to_numpy() for x in batch.column(c)] for c in ("a", "b")])
                found = aligned(tokens, va, vb)
                n_a, n_b = np.diff(tokens.cuts_a).tolist(), np.diff(tokens.cuts_b).tolist()
                cuts = np.searchsorted(found.run, np.arange(len(keys) + 1))
                rows = [(pack, r, keys[r], places[r], None, n_a[r], n_b[r], int(found.n_groups[r]), int(found.n_links[r]), None,
                         found.written[r].tobytes(), found.pair[cuts[r]:cuts[r + 1]], None, None) for r in range(len(keys))]
                yield _batch([*rows, _pack_row(pack, found)], _MEASURED)

    return runs.mapInArrow(run, MEASURED)


def pair_counts(short: DataFrame, long: DataFrame, size_b: int) -> DataFrame:
    """pair, its number of documents, and whether no pair of its id of a has more."""
    packs = short.filter("at = -1").select(F.explode(F.arrays_zip("pairs", "documents")).alias("x")).select(
        F.col("x.pairs").alias("pair"), F.col("x.documents").alias("documents"))
    spread = (long.filter("at >= 0").select("key", F.explode("pairs").alias("pair")).distinct()
              .select("pair", F.lit(1).cast("long").alias("documents")))
    counts = packs.union(spread).groupBy("pair").agg(F.sum("documents").alias("documents"))
    a = F.floor(F.col("pair") / size_b)  # no more pairs of an id than b has ids
    return counts.withColumn("best", F.col("documents") == F.max("documents").over(Window.partitionBy(a)))


SCORED = "key long, place long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, written binary"
_SCORED = pa.schema([(n, _MEASURED.field(n).type if n in _MEASURED.names else pa.int64())
                     for n in (part.split(" ")[0] for part in SCORED.split(", "))])


def _scored(rows: pa.Table, counts: pa.Table) -> pa.Table:
    """The rows of a pack with the sums over their links."""
    head = rows.filter(pc.equal(rows.column("at"), -1)).to_pylist()[0]
    order = np.argsort(counts.column("pair").to_numpy())
    documents, best = (counts.column(c).to_numpy(zero_copy_only=False)[order].astype(np.int64) for c in ("documents", "best"))
    keys, times = packed.unpack(head["blob"]) if head["blob"] else (np.empty(0, np.uint64), np.empty(0, np.uint32))
    run, at = np.divmod(keys.astype(np.int64), max(len(order), 1))
    rows = rows.filter(pc.fill_null(pc.not_equal(rows.column("at"), -1), True))
    place = pc.fill_null(rows.column("at"), -1).to_numpy()
    cuts = np.searchsorted(run, np.arange(place.max(initial=-1) + 2))
    for name, values in (("n_best", best), ("count_sum", documents)):
        total = np.concatenate([[0], np.cumsum(values[at] * times)]) if len(at) else np.zeros(1, np.int64)
        sums = total[cuts[1:]] - total[cuts[:-1]]
        rows = rows.append_column(name, pa.array(np.where(place >= 0, sums[place] if len(sums) else 0, 0), pa.int64()))
    return rows.select(_SCORED.names).cast(_SCORED)


NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def _whole_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums, and the digest of the groups, over rows in order of key and place; a text may cross batches."""
    schema = pa.schema([("key", pa.int64()), *[(n, pa.int64()) for n in NUMBERS], ("groups_sha256", pa.string())])
    key, sums, sha = None, None, None

    def done() -> Iterator[pa.RecordBatch]:
        if key is not None:
            yield _batch([(key, *sums, sha.hexdigest())], schema)

    for batch in batches:
        for row in zip(batch.column("key").to_pylist(), *[batch.column(n).to_pylist() for n in NUMBERS], batch.column("written"), strict=True):
            if row[0] != key:
                yield from done()
                key, sums, sha = row[0], list(row[1:-1]), hashlib.sha256(row[-1].as_py())
            else:
                sums = [x + y for x, y in zip(sums, row[1:-1], strict=True)]
                sha.update(b";")
                sha.update(row[-1].as_py())
    yield from done()


@dataclass
class Alignment:
    """``documents``: the figures of each row. ``pairs``: id_a, id_b, documents and best of each linked pair (staged)."""

    documents: DataFrame
    pairs: DataFrame


def _long_runs(df: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with short texts; staged keys and ids of long ones; staged closed runs of those whose bytes are kept."""
    rows = bare(df, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    is_long = F.char_length("text") > RANGE_CHARS
    named = stage(rows.filter(is_long).withColumn("key", F.monotonically_increasing_id()), "align-long")
    parts = stage(cut_texts(named), "align-ranges")
    found = stage(fragments(parts.repartition(pieces(parts.count() * RANGE_CHARS, PACK_BYTES), "key", "place"), path_a, path_b), "align-fragments")
    bad = found.filter("kind = 'bad'").select("key").distinct()
    runs = stage(closed_runs(found.join(bad, "key", "left_anti").select(found.columns)), "align-runs")
    return rows.filter(F.coalesce(~is_long, F.lit(True))), named.select("key", "doc_id"), runs


def align(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> Alignment:
    """The alignment of every text by a byte-level vocabulary (``path_a``) and a sentencepiece one (``path_b``).

    documents: doc_id, n_a and n_b (tokens), n_groups, n_links, n_best (links whose number of documents is the greatest of their
    id of a, ties included), count_sum (of these numbers over all links) and groups_sha256. Null and empty texts, and
    texts that either vocabulary does not write byte by byte, have no tokens: zeros and an empty digest. Each row is a document of
    its own, also if it repeats another or has no id. Extra columns are left out, an empty table gives no rows.
    """
    size_b = vocabularies(path_a, path_b)[1].size
    rows, named, runs = _long_runs(df, path_a, path_b, id_col, text_col)
    short = stage(measured_texts(rows, path_a, path_b), "align-short")
    long = stage(measured_runs(runs, path_a, path_b), "align-long-runs")
    counts = stage(pair_counts(short, long, size_b), "align-pairs")
    both = short.union(long)
    asked = both.filter("at = -1").select("pack", F.explode("pairs").alias("pair"))
    answers = asked.join(counts, "pair").select(F.col("pack").alias("to"), "pair", "documents", "best")
    scored = stage(both.drop("pairs", "documents").groupBy("pack").cogroup(answers.groupBy("to")).applyInArrow(_scored, SCORED), "align-scored")
    sums = (scored.filter("key is not null").select("key", "place", *NUMBERS, "written").repartition("key").sortWithinPartitions("key", "place")
            .mapInArrow(_whole_texts, "key long, " + ", ".join(f"{n} long" for n in NUMBERS) + ", groups_sha256 string"))
    of_long = named.join(sums, "key", "left").select(
        "doc_id", *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in NUMBERS], F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
    documents = scored.filter("key is null").select("doc_id", *NUMBERS, "groups_sha256").union(of_long)
    pairs = counts.select(F.floor(F.col("pair") / size_b).cast("int").alias("id_a"), (F.col("pair") % size_b).cast("int").alias("id_b"), "documents", "best")
    return Alignment(documents, pairs)


def aligned_groups(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, place (order of a long text's rows) and groups (an array of the ids of a and b) of every text with tokens."""
    def groups_of(a: np.ndarray, b: np.ndarray, va: Vocabulary, vb: Vocabulary) -> list[dict]:
        ends_a, ends_b = np.cumsum(va.spelling.widths[a]), np.cumsum(vb.spelling.widths[b])
        cuts_a, cuts_b = np.flatnonzero(_common(ends_a, ends_b)) + 1, np.flatnonzero(_common(ends_b, ends_a)) + 1
        return [{"a": x.tolist(), "b": y.tolist()} for x, y in zip(np.split(a, cuts_a[:-1]), np.split(b, cuts_b[:-1]), strict=True)]

    made = pa.list_(pa.struct([("a", _ints), ("b", _ints)]))
    schema = pa.schema([("doc_id", pa.int64()), ("place", pa.int64()), ("groups", made)])
    kind = "doc_id long, place long, groups array<struct<a:array<int>,b:array<int>>>"

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        va, vb = vocabularies(path_a, path_b)
        for batch in (part for whole in batches for part in batch_slices(whole, PACK_BYTES)):
            ids = batch.column("doc_id").to_pylist()
            good, t = encoded([x or "" for x in batch.column("text").to_pylist()], va, vb)
            yield _batch([(ids[i], 0, groups_of(t.a[t.cuts_a[r]:t.cuts_a[r + 1]], t.b[t.cuts_b[r]:t.cuts_b[r + 1]], va, vb))
                          for r, i in enumerate(good.tolist())], schema)

    def runs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        va, vb = vocabularies(path_a, path_b)
        for batch in batches:
            for d, p, a, b in zip(*[batch.column(c) for c in ("doc_id", "place", "a", "b")], strict=True):
                yield _batch([(d.as_py(), p.as_py(), groups_of(a.values.to_numpy(), b.values.to_numpy(), va, vb))], schema)

    rows, named, runs = _long_runs(df, path_a, path_b, id_col, text_col)
    return rows.mapInArrow(texts, kind).union(runs.join(named, "key").select("doc_id", "place", "a", "b").mapInArrow(runs_of, kind))
