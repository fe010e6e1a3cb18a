"""Documents whose sets of word n-grams are nearly equal (Jaccard), by vertical partitioning.

1. Documents with equal sets become one node, reduced before anything is compared.
2. Document frequencies of all n-grams give the global order: by frequency class, then by hash.
   N-grams of one node only stand first in the order; they cannot be shared and are only counted.
3. Two linked sets share one of their first n - ceil(t n) + 1 n-grams (prefix filter), so most
   documents have no partner and drop out here.
4. The order is cut into fragments. Each fragment counts the overlap of a pair by itself,
   and the counts are summed per pair.
5. Pairs are formed in rounds. The first two compare each node with one hub for each n-gram of its
   prefix: as many pairs as prefix entries. Linked nodes become components. The last round compares what
   is left: nodes of one n-gram that are in different components, and that neither their lengths, their places in
   the order, nor their distances to the hub (triangle inequality) keep apart.
   No link between different components is lost, so the components are exact, and a large group of near
   copies costs pairs in proportion to its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from arbolytics.llm import packed
from arbolytics.llm.common import bare, batch_slices, hash_group, pieces, text_bytes
from arbolytics.llm.components import components
from arbolytics.llm.words import mix, word_hashes
from arbolytics.session import stage

GROUP_BYTES = 8 << 20
NONE = np.iinfo(np.int64).max


def shingle_sets(texts: pa.ChunkedArray | pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, ascending within a text, and the texts' cuts.

    A text of fewer words has its whole sequence as its only n-gram; one without words has none.
    """
    words = word_hashes(texts, fold=True)
    runs = words.runs(length)
    counts = np.diff(words.cuts)
    short = {k: words.runs(k) for k in np.unique(counts[counts < length]).tolist() if k}
    found, sizes = [], np.zeros(len(counts), np.int64)
    for d, (a, n) in enumerate(zip(words.cuts[:-1].tolist(), counts.tolist(), strict=True)):
        if not n:
            continue
        if n < length:
            found.append(short[n][a:a + 1])
        else:
            part = np.sort(runs[a:a + n - length + 1])
            found.append(part[np.concatenate([[True], part[1:] != part[:-1]])])
        sizes[d] = len(found[-1])
    return np.concatenate(found) if found else np.empty(0, np.uint64), np.concatenate([[0], np.cumsum(sizes)])


def signatures(sets: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set: equal sets, equal sums."""
    out = []
    for salt in (0x8EBC6AF09C88C6E3, 0x589965CC75374CC3):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(sets ^ np.uint64(salt)), dtype=np.uint64)])
        out.append((total[cuts[1:]] - total[cuts[:-1]]).view(np.int64))
    return out[0], out[1]


def with_signatures(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in batch_slices(whole)):
            sets, cuts = shingle_sets(batch.column("text"), length)
            a, b = signatures(sets, cuts)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "row": batch.column("row"), "n_shingles": np.diff(cuts), "s1": a, "s2": b})

    return run


def _chosen(docs: pa.Table, nodes: pa.Table, length: int) -> list[tuple[int, np.ndarray]]:
    """The sets of the documents that stand for a node of this group, once each."""
    wanted = dict(zip(zip(*(nodes.column(c).to_pylist() for c in ("doc_id", "s1", "s2")), strict=True),
                      nodes.column("node").to_pylist(), strict=True))
    sets, cuts = shingle_sets(docs.column("text"), length)
    a, b = signatures(sets, cuts)
    out = []
    for d, key in enumerate(zip(docs.column("doc_id").to_pylist(), a.tolist(), b.tolist(), strict=True)):
        node = wanted.pop(key, None)
        if node is not None:
            out.append((node, sets[cuts[d]:cuts[d + 1]]))
    return out


def _frequencies(length: int, buckets: int):
    def run(docs: pa.Table, nodes: pa.Table) -> pa.Table:
        if not docs.num_rows or not nodes.num_rows:
            return packed.to_table([])
        chosen = [s for _, s in _chosen(docs, nodes, length)]
        keys = np.sort(np.concatenate(chosen)) if chosen else np.empty(0, np.uint64)
        if not len(keys):
            return packed.to_table([])
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        counts = np.diff(np.append(first, len(keys))).astype(np.uint32)
        return packed.to_table(list(packed.send(docs.column("grp")[0].as_py(), buckets, keys[first], counts)))

    return run


def _shared(table: pa.Table) -> pa.Table:
    """The n-grams of two nodes or more, with their frequency class, sent back."""
    keys, columns, owner = packed.gather(table.column("grp").to_pylist(), table.column("blob").to_pylist())
    if not len(keys):
        return packed.to_table([])
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    n = np.diff(np.append(first, len(keys)))
    total = np.repeat(np.add.reduceat(columns[0].astype(np.int64), first), n)
    return packed.to_table(packed.answer(owner, total > 1, keys, np.log2(total).astype(np.uint8)))


SETS = "node long, n long, alone long, n_prefix int, classes array<int>, tokens array<long>"
SETS_SCHEMA = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("alone", pa.int64()), ("n_prefix", pa.int32()),
                         ("classes", pa.list_(pa.int32())), ("tokens", pa.list_(pa.int64()))])


def _ordered(length: int, parts: int, whole: int):
    """Nodes that can have a partner: their shared n-grams in global order."""
    def run(docs: pa.Table, side: pa.Table) -> pa.Table:
        nodes, blobs = side.filter(pa.compute.is_valid(side.column("node"))), side.column("blob").drop_null().to_pylist()
        if not docs.num_rows or not nodes.num_rows or not blobs:
            return SETS_SCHEMA.empty_table()
        keys, classes = packed.merge(blobs)
        rows = []
        for node, mine in _chosen(docs, nodes, length):
            at = packed.positions(mine, keys)
            at = at[at >= 0]
            n, alone = len(mine), len(mine) - len(at)
            prefix = n + (-n * parts // whole) + 1 - alone  # n - ceil(t n) + 1, less those of this node only
            if prefix > 0 and len(at):
                at = at[np.argsort(classes[at], kind="stable")]
                rows.append((node, n, alone, min(prefix, len(at)), classes[at].astype(np.int32), keys[at].view(np.int64)))
        if not rows:
            return SETS_SCHEMA.empty_table()
        return pa.table([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), SETS_SCHEMA, strict=True)], schema=SETS_SCHEMA)

    return run


def candidate_sets(rows: DataFrame, length: int, parts: int, whole: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Staged: documents with signatures; nodes; ordered sets of the nodes that can have a partner."""
    n = pieces(text_bytes(rows), GROUP_BYTES)
    signed = stage(rows.withColumn("row", row_hash(F.col("text"))).mapInArrow(
        with_signatures(length), "doc_id long, row long, n_shingles long, s1 long, s2 long"), "ngram-documents")
    nodes = stage(signed.filter("n_shingles > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("doc_id"))
                  .withColumn("node", F.monotonically_increasing_id()).withColumn("grp", hash_group("doc_id", n)), "ngram-nodes")
    docs = rows.withColumn("grp", hash_group("doc_id", n))
    shared = (docs.groupBy("grp").cogroup(nodes.groupBy("grp")).applyInArrow(_frequencies(length, n), packed.BLOBS)
              .groupBy("bucket").applyInArrow(_shared, packed.BLOBS))
    side = nodes.unionByName(shared.select("grp", "blob"), allowMissingColumns=True)
    sets = docs.groupBy("grp").cogroup(side.groupBy("grp")).applyInArrow(_ordered(length, parts, whole), SETS)
    return signed, nodes, stage(sets, "ngram-sets")


def segments(sets: DataFrame, fragments: int) -> DataFrame:
    """The sets cut at fixed places of the global order: node, fragment and its n-grams.

    Cuts have equal numbers of n-gram occurrences between them; they follow from the counts of the
    frequency classes (64 at most) and the hashes, which are spread evenly within a class.
    """
    counts = {r.c: r.k for r in sets.select(F.explode("classes").alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("k")).collect()}
    total, before, start = sum(counts.values()) or 1, {}, 0
    for c in sorted(counts):
        before[c], start = start, start + counts[c]
    lookup = lambda values: F.create_map(*[F.lit(x) for c in sorted(counts) for x in (c, float(values[c]))])
    each = sets.select("node", F.explode(F.arrays_zip("classes", "tokens")).alias("t")).select("node", "t.classes", "t.tokens")
    if not counts:
        return each.select("node", F.lit(0).alias("fragment"), F.array("tokens").alias("tokens"))
    share = (F.when(F.col("tokens") < 0, F.col("tokens") + F.lit(2.0**64)).otherwise(F.col("tokens").cast("double"))) / 2.0**64
    rank = F.element_at(lookup(before), F.col("classes")) + F.element_at(lookup(counts), F.col("classes")) * share
    fragment = F.least(F.floor(rank / total * fragments), F.lit(fragments - 1)).cast("int")
    return each.groupBy("node", fragment.alias("fragment")).agg(F.collect_list("tokens").alias("tokens"))


def overlaps(pairs: DataFrame, cut: DataFrame) -> DataFrame:
    """a, b and their overlap: counted in each fragment, summed for each pair."""
    left = cut.select(F.col("node").alias("a"), "fragment", F.col("tokens").alias("left"))
    right = cut.select(F.col("node").alias("b"), "fragment", F.col("tokens").alias("right"))
    partial = pairs.select("a", "b").join(left, "a").join(right, ["b", "fragment"]).select(
        "a", "b", F.size(F.array_intersect("left", "right")).alias("k"))
    return partial.groupBy("a", "b").agg(F.sum("k").alias("overlap"))


def _linked(pairs: DataFrame, cut: DataFrame, parts: int, whole: int) -> DataFrame:
    """The pairs with their distance and whether they are linked; a pair without overlap is missing."""
    union = F.col("na") + F.col("nb") - F.col("overlap")
    return pairs.join(overlaps(pairs, cut), ["a", "b"]).select(
        "a", "b", (1 - F.col("overlap") / union).alias("distance"), (F.col("overlap") * whole >= union * parts).alias("linked"))


def near_sets(sets: DataFrame, parts: int, whole: int, fragments: int) -> DataFrame:
    """Staged links (u, v) between nodes, enough to join all nodes that links join."""
    cut = stage(segments(sets, fragments), "ngram-fragments")
    entries = stage(sets.select("node", "n", "alone", F.posexplode(F.slice("tokens", F.lit(1), F.col("n_prefix"))).alias("i", "token"))
                    .select("token", "node", "n", "alone", (F.col("alone") + F.col("i")).alias("place")), "ngram-prefixes")
    # The hub of a list is its node with the fewest n-grams of its own: the text that near copies were made of, if it is there.
    hubs = (entries.groupBy("token").agg(F.min(F.struct("alone", "node", "n")).alias("h"), F.count(F.lit(1)).alias("k"))
            .filter("k > 1").select("token", F.col("h.node").alias("hub"), F.col("h.n").alias("hub_n")))
    entries = stage(entries.join(hubs, "token"), "ngram-lists")
    lengths_fit = F.least("na", "nb") * whole >= F.greatest("na", "nb") * parts
    stars = (entries.filter("node != hub").select(F.col("hub").alias("a"), F.col("node").alias("b"), F.col("hub_n").alias("na"),
                                                  F.col("n").alias("nb")).distinct().filter(lengths_fit))
    first = stage(_linked(stars, cut, parts, whole), "ngram-stars")
    links = first.filter("linked").select(F.col("a").alias("u"), F.col("b").alias("v"))
    found = stage(components(links), "ngram-components")

    # Nodes outside the hub's component meet the one with the fewest own n-grams among them.
    outside = (entries.join(found, "node", "left").join(found.select(F.col("node").alias("hub"), F.col("component").alias("hub_component")), "hub", "left")
               .filter("node != hub").filter(~F.coalesce(F.col("component") == F.col("hub_component"), F.lit(False)))
               .select("token", "node", "n", "alone"))
    outside = stage(outside, "ngram-outside")
    seconds = (outside.groupBy("token").agg(F.min(F.struct("alone", "node", "n")).alias("h"), F.count(F.lit(1)).alias("k"))
               .filter("k > 1").select("token", F.col("h.node").alias("a"), F.col("h.n").alias("na")))
    stars = (outside.join(seconds, "token").filter("node != a").select("a", F.col("node").alias("b"), "na", F.col("n").alias("nb"))
             .distinct().filter(lengths_fit))
    more = stage(_linked(stars, cut, parts, whole), "ngram-stars").filter("linked").select(F.col("a").alias("u"), F.col("b").alias("v"))
    if not more.isEmpty():
        links = links.union(more)
        found = stage(components(links), "ngram-components")

    # What is left: nodes of one list in different components. All but the list's largest component are few.
    placed = (entries.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
              .join(first.select(F.col("a").alias("hub"), F.col("b").alias("node"), "distance"), ["hub", "node"], "left")
              .withColumn("distance", F.when(F.col("node") == F.col("hub"), 0.0).otherwise(F.col("distance"))))
    placed = stage(placed, "ngram-lists")
    sizes = placed.groupBy("token", "component").agg(F.count(F.lit(1)).alias("k"))
    largest = sizes.groupBy("token").agg(F.max(F.struct("k", "component")).alias("top"), F.count(F.lit(1)).alias("groups")).filter(
        "groups > 1").select("token", F.col("top.component").alias("largest"))
    open_lists = stage(placed.join(largest, "token"), "ngram-open")
    one = open_lists.filter("component != largest").select(
        "token", F.col("node").alias("a"), F.col("n").alias("na"), F.col("place").alias("pa"), F.col("component").alias("ca"), F.col("distance").alias("da"))
    two = open_lists.select("token", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("place").alias("pb"), F.col("component").alias("cb"),
                            F.col("distance").alias("db"), (F.col("component") == F.col("largest")).alias("in_largest"))
    at_most = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))  # shared n-grams, if this is the first
    far = F.coalesce(F.abs(F.col("da") - F.col("db")) > 1 - parts / whole + 1e-9, F.lit(False))
    rest = (one.join(two, "token").filter((F.col("ca") != F.col("cb")) & (F.col("in_largest") | (F.col("a") < F.col("b"))))
            .filter(lengths_fit).filter(at_most * (whole + parts) >= (F.col("na") + F.col("nb")) * parts).filter(~far)
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                    F.when(F.col("a") < F.col("b"), F.col("na")).otherwise(F.col("nb")).alias("na"),
                    F.when(F.col("a") < F.col("b"), F.col("nb")).otherwise(F.col("na")).alias("nb")).distinct())
    second = _linked(stage(rest, "ngram-rest"), cut, parts, whole)
    return links.union(second.filter("linked").select(F.col("a").alias("u"), F.col("b").alias("v")))


def ngram_components(df: DataFrame, length: int = 5, parts: int = 80, whole: int = 100, fragments: int = 4,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row; row (a hash of its text) and component (a number of its class).

    Sets are the distinct n-grams of ``length`` words (A-Z count as a-z; words are runs of other than
    ASCII white space); fewer words count as one n-gram. Two rows are linked when
    ``whole * intersection >= parts * union``. component_id is the smallest id that links reach,
    the row's own included. Rows without words have no n-gram and no links: their
    component is their own id. Equal texts are linked; rows that repeat an id are rows of their own. A
    null id is never the smallest; the component of rows without any id is null. Extra columns are left
    out, an empty table gives no rows.
    """
    rows = bare(df, doc_id=id_col, text=text_col).select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NONE)).alias("doc_id"),
                                                         F.col("text").cast("string"))
    signed, nodes, sets = candidate_sets(rows, length, parts, whole)
    found = components(near_sets(sets, parts, whole, fragments))
    placed = nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = stage(placed, "ngram-placed")
    smallest = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = stage(placed.join(smallest, "component").select("s1", "s2", "component", "component_id"), "ngram-named")
    out = signed.join(named, ["s1", "s2"], "left")
    known = lambda c: F.when(F.col(c) != NONE, F.col(c))
    return out.select(known("doc_id").alias("doc_id"), F.col("n_shingles"),
                      F.when(F.col("n_shingles") == 0, known("doc_id")).otherwise(known("component_id")).alias("component_id"), "row", "component")


def keep_first(df: DataFrame, classes: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that are the first of their class, by id and then by a hash of the text; all columns pass.

    ``classes`` is what ``ngram_components`` gave for ``df``. Rows without words are in no class and
    stay. Of rows with equal id and text in a class one stays.
    """
    ids = classes.select(F.coalesce("doc_id", F.lit(NONE)).alias("_doc"), F.col("row").alias("_row"), "component", "n_shingles")
    first = (ids.filter("n_shingles > 0").groupBy("component", "_doc", "_row").agg(F.count(F.lit(1)).alias("_copies"))
             .groupBy("component").agg(F.min(F.struct("_doc", "_row", "_copies")).alias("f")).select("f.*"))
    kept = stage(first.union(ids.filter("n_shingles = 0").select("_doc", "_row", F.lit(1).cast("long")).distinct()), "ngram-kept")
    keyed = df.withColumns({"_doc": F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NONE)), "_row": row_hash(F.col(f"`{text_col}`"))})
    found = keyed.join(kept, ["_doc", "_row"])
    if kept.filter("_copies > 1").isEmpty():
        return found.select(df.columns)
    return found.filter("_copies = 1").union(found.filter("_copies > 1").dropDuplicates(["_doc", "_row"])).select(df.columns)


def row_hash(text: Column) -> Column:
    return F.xxhash64(text.cast("string"))
