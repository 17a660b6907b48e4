"""The registered queries of the corpus operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import table
from quarry.llm.exact_dedup import exact_dedup
from quarry.llm.fingerprints import edited_fingerprints
from quarry.llm.language_id import held_out, identify, network_of
from quarry.llm.line_dedup import dedup_lines
from quarry.llm.mixing import mix
from quarry.llm.prefix_trie import prefix_trie, shared_starts, turns_of
from quarry.llm.sharding import shard_documents
from quarry.llm.simhash import simhash_groups
from quarry.llm.spelling_variants import spelling_variants, vocabulary
from quarry.llm.suffix_dedup import remove_repeats
from quarry.llm.threshold_search import top_k
from quarry.llm.tokens import decode, encode
from quarry.llm.warc import archive, lookup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


@query("""
WITH texts AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS content FROM documents
), keyed AS (SELECT doc_id, sha256(content) AS text_sha256 FROM texts),
groups AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM keyed GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM keyed JOIN groups USING (text_sha256)
""")
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query()
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_groups(table(spark, sf_dir, "documents"), radius=4, width=4, seed=42)
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query()
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, network_of(docs), carry=["doc_id"])
    return found.select(F.col("carried.doc_id").alias("doc_id"), "lang_pred", "score").withColumn("held_out", held_out())


@query()
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode(docs, "text", ranks, public_tokenizers.PATTERN).select(
        F.col("carried.doc_id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "ids"
    )
    return decode(encoded, "ids", ranks, public_tokenizers.PATTERN).select(
        "carried.doc_id", "carried.n_tokens", "carried.ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query()
def op6_prefix_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = edited_fingerprints(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return found.select(F.col("carried.doc_id").alias("doc_id"), *[c for c in found.columns if c != "carried"])


@query()
def op7_balanced_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), shards=8).select(
        F.col("id").alias("doc_id"),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query()
def op9_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents").select("doc_id", "source"))
    return mixed.select("carried.doc_id", "carried.source", "block", "slot", "release", "deadline", "place")


@query("""
WITH pages_ AS (
    SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes,
           sha1(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
    SELECT html, max(page_id) AS first_id FROM pages_ WHERE payload_bytes >= 1000 GROUP BY html
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id < first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < first_id THEN first_id END AS refers_to
FROM pages_ LEFT JOIN firsts USING (html)
""")
def op2_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures, index, folder = archive(table(spark, sf_dir, "pages"))
    return lookup(captures, index, folder).drop("url")


@query("""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
windows AS (
    SELECT doc_id, line, md5(lines[line] || chr(10) || lines[line + 1]) AS digest
    FROM (SELECT doc_id, lines, unnest(range(1, len(lines))) AS line FROM docs)
), later AS (
    SELECT doc_id, line FROM windows QUALIFY row_number() OVER (PARTITION BY digest ORDER BY doc_id, line) > 1
), gone AS (SELECT DISTINCT doc_id, unnest([line, line + 1]) AS line FROM later),
runs AS (
    SELECT doc_id, count(*) AS n_removed, count(*) FILTER (new) AS n_runs
    FROM (SELECT doc_id, coalesce(line - lag(line) OVER (PARTITION BY doc_id ORDER BY line) > 1, true) AS new FROM gone)
    GROUP BY doc_id
), kept AS (
    SELECT doc_id, string_agg(content, chr(10) ORDER BY line) AS content
    FROM (SELECT doc_id, unnest(lines) AS content, unnest(range(1, len(lines) + 1)) AS line FROM docs)
    ANTI JOIN gone USING (doc_id, line) GROUP BY doc_id
)
SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_runs, 0) AS n_runs,
       sha256(coalesce(content, '')) AS kept_sha256
FROM docs LEFT JOIN runs USING (doc_id) LEFT JOIN kept USING (doc_id)
""")
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), window=2)
    return found.select("carried.doc_id", "n_lines", "n_removed", "n_runs", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("""
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM usable q, usable c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
""")
def op11_threshold_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 50 == 0, k=5, scale=256.0)


@query("""
WITH RECURSIVE runs AS (
    SELECT doc_id, run, count(*) AS times FROM (
        SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
        FROM documents)
    WHERE length(run) >= 7 GROUP BY doc_id, run
), bytes AS (  -- UTF-8, after the register's first value
    SELECT run, doc_id, times, list_prepend(4294967295, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
        lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, CAST(unicode(c) AS BIGINT) - 64] END))) AS bytes FROM runs
), hashed AS (  -- crc32, bit by bit
    SELECT run, times, xor(list_reduce(bytes, lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) AS h FROM bytes
), vocabulary AS (
    SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
        SELECT times, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
    WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2
), holes AS (
    SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS hole
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM vocabulary)
), near AS (
    SELECT a.word, b.word AS other, b.n FROM holes a JOIN holes b USING (p, hole) WHERE a.word <> b.word
    UNION SELECT holes.word, v.word, v.n FROM holes JOIN vocabulary v ON v.word = hole
    UNION SELECT v.word, holes.word, holes.n FROM holes JOIN vocabulary v ON v.word = hole
), best AS (
    SELECT word, other, n, count(*) OVER (PARTITION BY word) AS n_near FROM near
    QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, other) = 1
), forms AS (
    SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN b.n >= 10 * v.n THEN other END AS form,
           CASE WHEN b.n >= 10 * v.n THEN b.n END AS form_n FROM vocabulary v LEFT JOIN best b USING (word)
), followed AS (
    SELECT word, word AS root FROM forms
    UNION ALL SELECT followed.word, forms.form FROM followed JOIN forms ON forms.word = root WHERE forms.form IS NOT NULL
)
SELECT forms.word, form, root, forms.n, n_near, form_n FROM forms JOIN followed USING (word)
WHERE root IN (SELECT word FROM forms WHERE form IS NULL)
""")
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = vocabulary(table(spark, sf_dir, "documents"), "doc_id", "text", least=7, occurrences=2, every=31)
    return spelling_variants(words, ratio=10).select("word", "form", "root", "n", "n_near", "form_n")


@query("""
WITH turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
           coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY n) AS turns FROM turns GROUP BY conv_id
), digits AS (  -- the bytes of the decimal id, after the register's first value
    SELECT conv_id, list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))) AS bytes FROM own
), shares AS (  -- crc32, bit by bit
    SELECT conv_id, xor(list_reduce(bytes, lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) % 6 AS h FROM digits
), rebuilt AS (
    SELECT o.conv_id, list_concat(coalesce(list_slice(b.turns, 1, h), []), list_slice(o.turns, h + 1, len(o.turns))) AS turns
    FROM own o JOIN shares USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100
), members AS (
    SELECT conv_id, len(turns) AS n, depth, list_slice(turns, 1, depth) AS path
    FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt)
), nodes AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, count(*) FILTER (n > depth) AS longer,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
    FROM members GROUP BY path, depth
), children AS (
    SELECT list_slice(path, 1, depth - 1) AS path, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2
), subtrees AS (
    SELECT list_slice(path, 1, d) AS path, d AS depth, count(*) FILTER (longer = 0) AS n_leaves,
           sum((n_convs - 1) * CASE WHEN depth > 0 THEN length(path[depth].text) ELSE 0 END) AS saved_tokens
    FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM nodes) GROUP BY 1, 2
)
SELECT nodes.conv_id, nodes.depth, parents.conv_id AS parent_conv_id, nodes.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, nodes.ends_sha256
FROM nodes JOIN subtrees USING (path, depth) LEFT JOIN children USING (path, depth)
LEFT JOIN nodes parents ON nodes.depth > 0 AND parents.depth = nodes.depth - 1 AND parents.path = list_slice(nodes.path, 1, nodes.depth - 1)
""")
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = turns_of(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    return prefix_trie(*shared_starts(turns, hundred=100, most=6))
