"""Benchmark items in texts, by pieces and edit distance.

Each item gets an error budget of a share of its length and is cut into one piece more
than the budget: with no more errors than that, one piece stands in the text unchanged
(pigeonhole). An automaton finds all pieces of all items in one pass over a text; around
each hit, Myers' bit-parallel algorithm finds the distance of the item to the best matching
passage.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from arbolytics.llm.common import bare

ERROR_SHARE = 0.05
#: Shorter pieces hit too many texts by chance; items too short for pieces of this length get a smaller budget.
LEAST_PIECE = 10
#: Characters of items in one automaton. More items take several automata, each over all texts.
BLOCK_CHARS = 400_000


def plain(text: str) -> str:
    """Lower case, runs of white space as one blank."""
    return " ".join(text.lower().split())


def budget(length: int, share: float = ERROR_SHARE) -> int:
    """Errors allowed: the share of the length, but pieces keep their least length."""
    return max(0, min(int(length * share), length // LEAST_PIECE - 1))


def cut(item: str, n: int) -> list[tuple[int, str]]:
    """n pieces of nearly equal length with their places."""
    ends = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


def within(pattern: str, text: str, most: int) -> bool:
    """Whether some passage of the text is at most ``most`` edits away from the pattern (Myers)."""
    full, top = (1 << len(pattern)) - 1, 1 << (len(pattern) - 1)
    places: dict[str, int] = {}
    for i, c in enumerate(pattern):
        places[c] = places.get(c, 0) | 1 << i
    up, down, distance = full, 0, len(pattern)
    if distance <= most:
        return True
    for c in text:
        same = places.get(c, 0)
        across = (((same & up) + up) ^ up) | same
        plus, minus = down | (full & ~(across | up)), up & across
        distance += bool(plus & top) - bool(minus & top)
        if distance <= most:
            return True
        plus, minus, changed = (plus << 1) & full, (minus << 1) & full, same | down
        up, down = minus | (full & ~(changed | plus)), plus & changed
    return False


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int | None, str]], share: float = ERROR_SHARE):
        import ahocorasick

        self.items = [(i, plain(text)) for i, text in items]
        self.budgets = [budget(len(text), share) for _, text in self.items]
        at: dict[str, list[tuple[int, int]]] = {}
        for k, (_, text) in enumerate(self.items):
            if text:
                for place, piece in cut(text, self.budgets[k] + 1):
                    at.setdefault(piece, []).append((k, place))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in at.items():
            self.automaton.add_word(piece, (len(piece), owners))
        self.empty = not at
        if at:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> list[int | None]:
        """Sorted ids of the items that the text holds; null, for items without an id, comes last."""
        if self.empty or not text:
            return []
        text = plain(text)
        found: set[int] = set()
        tried: dict[int, int] = {}
        for end, (length, owners) in self.automaton.iter(text):
            for k, place in owners:
                if k in found:
                    continue
                item, most = self.items[k][1], self.budgets[k]
                # The item starts here if it is unchanged before the piece; it can start up to `most` further.
                start = end - length + 1 - place
                if tried.get(k) == start:
                    continue
                tried[k] = start
                if within(item, text[max(0, start - most):start + len(item) + most], most):
                    found.add(k)
        return sorted({self.items[k][0] for k in found}, key=lambda i: (i is None, i or 0))


_MATCHERS: dict[str, Matcher] = {}


def known_matcher(name: str, shared, share: float) -> Matcher:
    """The matcher of a broadcast block, built once for a worker."""
    if name not in _MATCHERS:
        _MATCHERS[name] = Matcher(shared.value, share)
    return _MATCHERS[name]


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int | None, str]]]:
    """Distinct items in blocks of bounded size; the driver holds one block at a time."""
    rows = bare(benchmark, item_id=id_col, text=text_col).filter("text is not null").distinct()
    block, chars = [], 0
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        if block and chars + len(row.text) > BLOCK_CHARS:
            yield block
            block, chars = [], 0
        block.append((row.item_id, row.text))
        chars += len(row.text)
    if block:
        yield block


def items_found(benchmark: DataFrame, text: Column, id_col: str = "item_id", text_col: str = "text",
                share: float = ERROR_SHARE) -> Column:
    """A column with the sorted ids of the benchmark items that each text holds.

    A text holds an item if a passage of it is at most ``budget(length of the item)`` edits
    away, both in lower case and with white space as single blanks. Null or empty texts and items
    match nothing; an item with two texts is found by either; items
    without an id are searched too, all of them found as one null at the end; an empty benchmark gives empty lists.
    Texts are searched whole. A block of items is broadcast; its size is bounded by ``BLOCK_CHARS``
    (or one longer item), and more items make more blocks.
    """
    context = benchmark.sparkSession.sparkContext

    def search(block) -> Column:
        shared, name = context.broadcast(block), uuid.uuid4().hex

        @F.pandas_udf("array<long>")
        def find(texts: pd.Series) -> pd.Series:
            return texts.map(known_matcher(name, shared, share).find)

        return find(text)

    found = [search(block) for block in item_blocks(benchmark, id_col, text_col)]
    out = F.array().cast("array<long>")
    for column in found:
        out = column if len(found) == 1 else F.array_union(out, column)
    return out if len(found) == 1 else F.array_sort(out)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 share: float = ERROR_SHARE) -> DataFrame:
    """doc_id, contaminated, n_items and item_ids of every row; cases as in ``items_found``."""
    found = bare(docs, doc_id=id_col, text=text_col).select(
        "doc_id", items_found(benchmark, F.col("text").cast("string"), share=share).alias("item_ids"))
    return found.select("doc_id", (F.size("item_ids") > 0).alias("contaminated"),
                        F.size("item_ids").cast("long").alias("n_items"), "item_ids")
