"""The registered queries of this package, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from arbolytics.llm import alignment, byte_bpe, decontaminate, html_text, language_id, line_dedup, merkle, neighbours, ngram_join, simhash, substring_dedup, token_files, warc
from arbolytics.llm.common import ship
from arbolytics.session import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
WORD_FILE, WORD_END = "word_bpe_49k.json", 2
RANK_FILE = "byte_bpe_multi_50k.tiktoken"
BYTE_FILE, PIECE_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_language_id")
def op1_language_id(spark, sf_dir):
    """The language of every document, learned from the texts that are not held out."""
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, learn=~language_id.held_out(F.col("doc_id")))
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected", "cross_entropy")


@query("op2_substring_dedup", r"""
    WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    s AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w),
    win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS k FROM s),
    least AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
    gone AS (SELECT DISTINCT doc_id, i + unnest(range(0, 50)) AS j FROM win JOIN least USING (k) WHERE m < doc_id),
    u AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM w),
    kept AS (SELECT u.doc_id, string_agg(word, ' ' ORDER BY u.j) FILTER (gone.j IS NULL) AS t, count(gone.j) AS n
             FROM u LEFT JOIN gone ON u.doc_id = gone.doc_id AND u.j = gone.j GROUP BY u.doc_id)
    SELECT w.doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
    FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id""")
def op2_substring_dedup(spark, sf_dir):
    """Words left after passages of 50 words that stand in an earlier document are removed."""
    found = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op3_neighbours")
def op3_neighbours(spark, sf_dir):
    """The 20 nearest vectors found for every twentieth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


@query("op4_token_files")
def op4_token_files(spark, sf_dir):
    """Token files written in id order, and what stands in them for each document."""
    manifest = token_files.write_token_files(table(spark, sf_dir, "documents"), token_files.token_folder(spark),
                                             public_tokenizers.path(WORD_FILE), WORD_END)
    return token_files.read_token_files(manifest, with_ids=False)


@query("op6_ngram_join", r"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x20\x09-\x0D]+') AS ws FROM documents),
    s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
                 ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) END) AS g FROM w),
    t AS (SELECT doc_id, list_sort(g) AS g FROM s),
    sets AS (SELECT g, len(g) AS n, min(doc_id) AS node FROM t WHERE len(g) > 0 GROUP BY g),
    e AS (SELECT node, n, unnest(g) AS x FROM sets),
    links AS (SELECT a.node AS u, b.node AS v FROM e a JOIN e b ON a.x = b.x AND a.node < b.node AND a.n * 100 >= b.n * 90 AND b.n * 100 >= a.n * 90
              GROUP BY a.node, a.n, b.node, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
    both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
    reach AS (SELECT node, node AS seen FROM sets UNION SELECT r.node, b.v FROM reach r JOIN both_ways b ON r.seen = b.u),
    named AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
    SELECT t.doc_id, len(t.g) AS n_shingles, coalesce(component_id, t.doc_id) AS component_id
    FROM t LEFT JOIN sets USING (g) LEFT JOIN named USING (node)""")
def op6_ngram_join(spark, sf_dir):
    """Classes of documents whose word 3-grams are nearly equal."""
    found = ngram_join.ngram_components(table(spark, sf_dir, "documents"), length=3, parts=90)
    return found.select("doc_id", "n_shingles", "component_id")


@query("op7_byte_bpe")
def op7_byte_bpe(spark, sf_dir):
    """Ids of every text and the bytes they decode to, as digests."""
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)


@query("op5_html_text")
def op5_html_text(spark, sf_dir):
    """Main text of every page."""
    return html_text.extract_text(table(spark, sf_dir, "pages"))


@query("op8_warc", """
    WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
    q AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last_id FROM p)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 1000 AND page_id < last_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 1000 AND page_id < last_id THEN last_id END AS refers_to
    FROM q""")
def op8_warc(spark, sf_dir):
    """A record for each page, written and read back through the index."""
    index = warc.write_archives(warc.classify(table(spark, sf_dir, "pages")), fresh_path(spark, "warc"))
    return warc.read_records(index, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op9_decontaminate")
def op9_decontaminate(spark, sf_dir):
    """Benchmark items in every document."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_line_dedup")
def op10_line_dedup(spark, sf_dir):
    """Every document without the lines that repeat an earlier one."""
    found = line_dedup.line_dedup(table(spark, sf_dir, "documents"), chars_per_edit=line_dedup.CHARS_PER_EDIT)
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query("op13_simhash")
def op13_simhash(spark, sf_dir):
    """Classes of documents whose fingerprints differ in two bits at most."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), distance=2, length=3)


def manifest_rows(docs: DataFrame) -> DataFrame:
    """Proofs of all rows; where 7 divides the checksum of its id, a row's version has one character more."""
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    manifest = merkle.build_manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"],
                                     changed={"n_chars": F.col("n_chars").cast("decimal(38,0)") + 1}, when=chosen & F.col("n_chars").isNotNull())
    return merkle.versions(manifest).select(F.col("key.id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root",
                                            (F.col("folded_root") == F.col("root")).alias("verified"))


@query("op12_merkle_manifest", r"""
    WITH RECURSIVE d AS (SELECT doc_id, coalesce('1' || lang, '0') AS tree, n_chars,
        [CASE WHEN x IS NULL THEN '-' ELSE strlen(x) || ':' || x END FOR x IN [CAST(doc_id AS VARCHAR), source, lang]] AS head,
        CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail,
        xor(4294967295, list_reduce(string_split(CAST(doc_id AS VARCHAR), ''), lambda crc, x: list_reduce(range(8),
            lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, xor(crc, ord(x))), 4294967295::UBIGINT)) % 7 = 0 AS chosen
        FROM (SELECT * REPLACE (CAST(doc_id AS BIGINT) AS doc_id) FROM documents)),
    l AS (SELECT *, sha256(array_to_string(head, '') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
          CASE WHEN chosen AND n_chars IS NOT NULL
               THEN sha256(array_to_string(head, '') || strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1) || tail) END AS changed FROM d),
    leaves AS (SELECT doc_id, tree, leaf, changed, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
               count(*) OVER (PARTITION BY tree) AS n FROM l),
    nodes AS (SELECT tree, 0 AS lvl, pos, leaf AS h, n FROM leaves
              UNION ALL SELECT tree, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2
              FROM nodes WHERE n > 1 GROUP BY tree, lvl, pos // 2, n),
    subroots AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
    upper_nodes AS (SELECT 0 AS lvl, pos, h, n FROM subroots
                    UNION ALL SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2
                    FROM upper_nodes WHERE n > 1 GROUP BY lvl, pos // 2, n),
    steps AS (SELECT a.tree, a.pos, v.lvl, (a.pos >> v.lvl) & 1 AS side, s.h
              FROM leaves a JOIN (SELECT DISTINCT tree, lvl FROM nodes WHERE n > 1) v ON a.tree = v.tree
              LEFT JOIN nodes s ON s.tree = a.tree AND s.lvl = v.lvl AND s.pos = xor(a.pos >> v.lvl, 1)
              UNION ALL SELECT a.tree, a.pos, 1000 + v.lvl, (r.pos >> v.lvl) & 1, s.h
              FROM leaves a JOIN subroots r ON a.tree = r.tree CROSS JOIN (SELECT DISTINCT lvl FROM upper_nodes WHERE n > 1) v
              LEFT JOIN upper_nodes s ON s.lvl = v.lvl AND s.pos = xor(r.pos >> v.lvl, 1)),
    paths AS (SELECT tree, pos, list(CASE WHEN h IS NULL THEN '' WHEN side = 1 THEN 'L' || h ELSE 'R' || h END ORDER BY lvl) AS path,
              coalesce(string_agg(h, '' ORDER BY lvl), '') AS proof FROM steps GROUP BY tree, pos),
    folded AS (SELECT a.doc_id, a.leaf, r.h AS subroot, (SELECT h FROM upper_nodes WHERE n = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
               list_reduce(coalesce(path, []), lambda x, s: sha256(CASE WHEN s[1] = 'L' THEN s[2:] || x ELSE x || s[2:] END),
                           coalesce(a.changed, a.leaf)) AS folded_root
               FROM leaves a JOIN subroots r ON a.tree = r.tree LEFT JOIN paths p ON a.tree = p.tree AND a.pos = p.pos)
    SELECT *, folded_root = root AS verified FROM folded""")
def op12_merkle_manifest(spark, sf_dir):
    """Every document's leaf, proof and version in the manifest of the whole table."""
    return manifest_rows(table(spark, sf_dir, "documents"))


@query("op11_alignment")
def op11_alignment(spark, sf_dir):
    """How the tokens of two vocabularies meet in every document."""
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_FILE), public_tokenizers.path(PIECE_FILE)).documents
