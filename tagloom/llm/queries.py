"""One query for each operator, with production parameters over its whole table, and the SQL for those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import (
    bpe,
    chat,
    codes,
    decontamination,
    lines,
    merkle,
    neighbours,
    quality,
    sharding,
    simhash,
    token_counts,
    urls,
    warc,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return neighbours.nearest(rows, rows.filter(F.col("vec_id") % 20 == 0), 20)


def op2_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat.format_chats(table(spark, folder, "conversations"))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), 3, 2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = lines.drop_repeated_lines(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, folder, "labels")))


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.token_counts(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = warc.archived(spark, table(spark, folder, "pages"))
    return pages.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(bpe.encode(table(spark, folder, "documents"), path, public_tokenizers.PATTERN))


def op9_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.placed(table(spark, folder, "documents"), 24)


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


URL_RULES = (
    ("org/", urls.ALLOW),
    ("example.org/es/", urls.BLOCK),
    ("example.org/en/1", urls.BLOCK),
    ("com/fr/", urls.ALLOW),
    ("com/de/", urls.BLOCK),
)


def op11_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return urls.judge(pages, urls.fit(pages, URL_RULES))


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(table(spark, folder, "documents"))


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return codes.compressed(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_nearest_neighbours,
        op2_chat_format,
        op3_simhash,
        op4_line_dedup,
        op5_quality,
        op6_token_counts,
        op7_warc,
        op8_byte_bpe,
        op9_shards,
        op10_decontamination,
        op11_url_filter,
        op12_merkle_manifest,
        op13_vector_codes,
    )
}

# CRC-32 of an ASCII text, bit by bit: seven zeros follow every byte, and each step shifts once.
_CRC32 = """xor(list_reduce(
    list_prepend(4294967295::BIGINT, flatten([[ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0] FOR c IN string_split({text}, '')])),
    lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295::BIGINT)"""


def _merkle_sql() -> str:
    def leaf(n_chars: str) -> str:
        values = ["doc_id", "source", "lang", n_chars, "text"]
        texts = [f"coalesce(strlen({v}::VARCHAR)::VARCHAR || ':' || {v}::VARCHAR, '-')" for v in values]
        return f"sha256({' || '.join(texts)})"

    # Every tree's nodes level by level; then, for each leaf, the other node of its pair on every level.
    def nodes(name: str, start: str) -> str:
        return f"""{name} AS (
            SELECT tree, 0 AS level, pos, digest, n FROM {start}
            UNION ALL
            SELECT tree, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 1) // 2
            FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 2
        )"""

    return f"""
        WITH RECURSIVE hashed AS (
            SELECT doc_id, coalesce('=' || lang, '') AS tree, {leaf("n_chars")} AS digest,
                   CASE WHEN {_CRC32.format(text="doc_id::VARCHAR")} % 7 = 0 THEN {leaf("(n_chars + 1)")} ELSE {leaf("n_chars")} END AS started
            FROM documents
        ), leaves AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos,
                   count(*) OVER (PARTITION BY tree) AS n FROM hashed
        ), {nodes("inner_nodes", "leaves")},
        subroots AS (
            SELECT '' AS tree, tree AS lang_tree, digest, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos,
                   count(*) OVER () AS n FROM inner_nodes WHERE n = 1
        ), {nodes("outer_nodes", "subroots")},
        steps AS (
            SELECT l.tree, l.pos, i.level, l.pos >> i.level AS place, o.digest AS other
            FROM leaves l JOIN (SELECT DISTINCT tree, level FROM inner_nodes WHERE n > 1) i ON i.tree = l.tree
            LEFT JOIN inner_nodes o ON o.tree = l.tree AND o.level = i.level AND o.pos = xor(l.pos >> i.level, 1)
            UNION ALL
            SELECT l.tree, l.pos, 1000 + i.level, s.pos >> i.level, o.digest
            FROM leaves l JOIN subroots s ON s.lang_tree = l.tree
            CROSS JOIN (SELECT DISTINCT level FROM outer_nodes WHERE n > 1) i
            LEFT JOIN outer_nodes o ON o.level = i.level AND o.pos = xor(s.pos >> i.level, 1)
        ), proofs AS (
            SELECT tree, pos, list(struct_pack(left_side := place % 2 = 1, other := coalesce(other, '')) ORDER BY level) AS path
            FROM steps GROUP BY tree, pos
        ), folds AS (
            SELECT l.tree, l.pos, 0 AS step, l.started AS digest, coalesce(p.path, []) AS path
            FROM leaves l LEFT JOIN proofs p ON p.tree = l.tree AND p.pos = l.pos
            UNION ALL
            SELECT tree, pos, step + 1,
                   sha256(CASE WHEN path[step + 1].left_side THEN path[step + 1].other || digest ELSE digest || path[step + 1].other END), path
            FROM folds WHERE step < len(path)
        )
        SELECT l.doc_id, l.digest AS leaf, s.digest AS subroot, r.digest AS root,
               sha256(array_to_string([sibling.other FOR sibling IN f.path], '')) AS proof_sha256,
               f.digest AS folded_root, f.digest = r.digest AS verified
        FROM leaves l JOIN folds f ON f.tree = l.tree AND f.pos = l.pos AND f.step = len(f.path)
        JOIN subroots s ON s.lang_tree = l.tree CROSS JOIN (SELECT digest FROM outer_nodes WHERE n = 1) r"""


def _codes_sql() -> str:
    def assigned(name: str, book: str) -> str:
        return f"""{name} AS MATERIALIZED (
            SELECT nth, part, min(struct_pack(away := away, entry := entry)) AS best FROM (
                SELECT c.nth, c.part, b.entry, sum((c.v - b.v) * (c.v - b.v)) AS away
                FROM numbers c JOIN {book} b ON b.part = c.part AND b.dim = c.dim GROUP BY c.nth, c.part, b.entry
            ) GROUP BY nth, part)"""

    def refitted(name: str, book: str, found: str) -> str:
        return f"""{name} AS MATERIALIZED (
            SELECT b.part, b.entry, b.dim, CASE WHEN m.n IS NULL THEN b.v ELSE ((m.s - ((m.s % m.n) + m.n) % m.n) // m.n)::BIGINT END AS v
            FROM {book} b LEFT JOIN (
                SELECT a.part, a.best.entry AS entry, c.dim, sum(c.v) AS s, count(*) AS n
                FROM {found} a JOIN numbers c ON c.nth = a.nth AND c.part = a.part GROUP BY ALL
            ) m ON m.part = b.part AND m.entry = b.entry AND m.dim = b.dim)"""

    rounds = ", ".join(
        f"{assigned(f'found{n}', f'book{n}')}, {refitted(f'book{n + 1}', f'book{n}', f'found{n}')}" for n in range(4)
    )
    return f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id) - 1 AS nth, vec_id, label, embedding FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), numbers AS MATERIALIZED (
            SELECT nth, (spot - 1) // (size // 4) AS part, (spot - 1) % (size // 4) AS dim, floor(1024 * x)::BIGINT AS v FROM (
                SELECT nth, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS spot, len(embedding) AS size FROM kept)
        ), book0 AS MATERIALIZED (SELECT part, nth AS entry, dim, v FROM numbers WHERE nth < 256), {rounds}, {assigned("last", "book4")},
        coded AS (
            SELECT nth, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, sum(best.away)::BIGINT AS error FROM last GROUP BY nth
        )
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, dim)) FROM book4) AS codebooks_sha256
        FROM kept JOIN coded USING (nth)"""


# DuckDB SQL. ASCII white space and letters are spelled out as in the operators.
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLES: dict[str, str] = {
    "op4_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS nth
            FROM documents
        ), keyed AS (
            SELECT *, translate(trim(line, {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
        ), repeated AS (
            SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
        ), marked AS (
            SELECT k.*, coalesce(r.owner <> k.doc_id, false) AS dropped FROM keyed k LEFT JOIN repeated r USING (key)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (NOT dropped), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op7_warc": """
        WITH digests AS (
            SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
        ), firsts AS (SELECT payload_digest, min(page_id) AS first FROM digests WHERE payload_bytes >= 100 GROUP BY 1)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to
        FROM digests LEFT JOIN firsts USING (payload_digest)""",
    "op12_merkle_manifest": _merkle_sql(),
    "op13_vector_codes": _codes_sql(),
}
