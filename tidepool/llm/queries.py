"""One query per operator (and the pipeline), with DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import exact_dedup, fill_in_middle, hnsw, mixing, packing, prefix_trie, quality, simhash, token_counts, token_store, toxicity, url_filters, warc
from tidepool.llm.encoding import public_tokenizer
from tidepool.shipping import ship
from tidepool.sources.tables import load, table_path

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}


def _query(fn: QueryFn) -> QueryFn:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


# Dated lists derived from the pages: which hosts, domains and pages join and leave a list, and when, follows from
# their MD5; captures are fetched on days that follow from their id.
_DAY = "date_add(DATE '2024-01-01', CAST({} AS INT))"


def _dated_lists(captures: DataFrame) -> DataFrame:
    def number(name: str):
        return F.conv(F.substring(F.md5(name), 1, 4), 16, 10).cast("int")

    def entry(rows: DataFrame, list_: str, verdict: str, action: str, day: str) -> DataFrame:
        return rows.select(F.lit(list_).alias("list"), F.lit(verdict).alias("verdict"), "pattern", F.lit(action).alias("action"), F.expr(_DAY.format(day)).alias("dated"))

    names = captures.select(url_filters.host(F.col("url")).alias("host"), url_filters.page(F.col("url")).alias("page"))
    hosts = names.select(F.col("host").alias("pattern")).distinct().withColumn("n", number("pattern"))
    parents = (
        names.where(r"host LIKE '%.%.%.%'").select(F.substring_index("host", ".", -3).alias("pattern")).distinct().withColumn("n", number("pattern"))
    )
    pages = names.select(F.col("page").alias("pattern")).distinct().withColumn("n", number("pattern"))
    parts = [
        entry(hosts.where("n % 4 = 0"), "spam", "block", "add", "n % 200"),
        entry(hosts.where("n % 8 = 0"), "spam", "block", "remove", "n % 200 + 60"),
        entry(hosts.where("n % 16 = 0"), "spam", "block", "add", "n % 200 + 120"),
        entry(parents.where("n % 5 = 0"), "domains", "block", "add", "n % 300"),
        entry(hosts.where("n % 6 = 1"), "partners", "allow", "add", "n % 250"),
        entry(pages.where("n % 50 = 0"), "takedown", "block", "add", "n % 365"),
        entry(pages.where("n % 50 = 0"), "takedown", "block", "remove", "n % 365 + 20"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@_query
def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page by the list entries active on the day it was fetched."""
    captures = load(spark, sf_dir, "pages", ["page_id", "url"]).withColumn("fetched", F.expr(_DAY.format("page_id * 37 % 366")))
    return url_filters.judge(captures, _dated_lists(captures)).select("page_id", "fetched", "filter.*")


SQL["op1_url_filters"] = r"""
WITH c AS (
    SELECT page_id, DATE '2024-01-01' + CAST(page_id * 37 % 366 AS INT) AS fetched,
           regexp_replace(regexp_extract(lower(coalesce(url, '')), '^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1), '\.+$', '') AS host,
           regexp_replace(regexp_extract(lower(coalesce(url, '')), '^[a-z][a-z0-9+.\-]*://[^/?#]*([^?#]*)', 1), '/+$', '') AS path
    FROM pages
), named AS (SELECT *, host || path AS page FROM c
), hosts AS (SELECT pattern, ('0x' || substr(md5(pattern), 1, 4))::INT AS n FROM (SELECT DISTINCT host AS pattern FROM named)
), parents AS (
    SELECT pattern, ('0x' || substr(md5(pattern), 1, 4))::INT AS n
    FROM (SELECT DISTINCT array_to_string(string_split(host, '.')[-3:], '.') AS pattern FROM named WHERE host LIKE '%.%.%.%')
), urls AS (SELECT pattern, ('0x' || substr(md5(pattern), 1, 4))::INT AS n FROM (SELECT DISTINCT page AS pattern FROM named)
), entries AS (
    SELECT 'spam' AS list, 1 AS side, pattern, 'add' AS action, DATE '2024-01-01' + n % 200 AS dated FROM hosts WHERE n % 4 = 0
    UNION ALL SELECT 'spam', 1, pattern, 'remove', DATE '2024-01-01' + (n % 200 + 60) FROM hosts WHERE n % 8 = 0
    UNION ALL SELECT 'spam', 1, pattern, 'add', DATE '2024-01-01' + (n % 200 + 120) FROM hosts WHERE n % 16 = 0
    UNION ALL SELECT 'domains', 1, pattern, 'add', DATE '2024-01-01' + n % 300 FROM parents WHERE n % 5 = 0
    UNION ALL SELECT 'partners', 0, pattern, 'add', DATE '2024-01-01' + n % 250 FROM hosts WHERE n % 6 = 1
    UNION ALL SELECT 'takedown', 1, pattern, 'add', DATE '2024-01-01' + n % 365 FROM urls WHERE n % 50 = 0
    UNION ALL SELECT 'takedown', 1, pattern, 'remove', DATE '2024-01-01' + (n % 365 + 20) FROM urls WHERE n % 50 = 0
), active AS (
    SELECT list, side, pattern, dated AS since, action, lead(dated) OVER (PARTITION BY list, side, pattern ORDER BY dated) AS until FROM entries
), valid AS (SELECT * FROM active WHERE action = 'add'
), probes AS (
    SELECT page_id, fetched, host, array_to_string(string_split(host, '.')[i:], '.') AS pattern, len(string_split(host, '.')) - i + 1 AS specificity
    FROM (SELECT *, unnest(range(1, greatest(len(string_split(host, '.')) - 1, 1) + 1)) AS i FROM named WHERE host <> '')
    UNION ALL SELECT page_id, fetched, host, page, 1000 FROM named WHERE host <> '' AND path <> ''
), ranked AS (
    SELECT p.page_id, v.*, row_number() OVER (PARTITION BY p.page_id ORDER BY p.specificity DESC, v.side, v.since, v.list) AS k
    FROM probes p JOIN valid v ON p.pattern = v.pattern AND p.fetched >= v.since AND (v.until IS NULL OR p.fetched < v.until)
)
SELECT n.page_id, n.fetched, n.host, coalesce(r.side = 1, false) AS blocked, r.list, r.pattern, r.since
FROM named n LEFT JOIN ranked r ON n.page_id = r.page_id AND r.k = 1
"""


@_query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens; each document ends with id 0."""
    return packing.pack_documents(load(spark, sf_dir, "documents", ["doc_id", "text"]), public_tokenizer(), end_id=0, capacity=2048)


@_query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule statistics of every document, the base rules, and the isolation forest's verdict."""
    found, name = quality.judged(load(spark, sf_dir, "documents", ["doc_id", "text"]), load(spark, sf_dir, "labels", ["doc_id", "quality"]))
    return found.select("doc_id", f"{name}.*")


@_query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through WARC archives and back."""
    index = warc.write_archives(load(spark, sf_dir, "pages", ["page_id", "url", "html"]))
    return warc.read_records(index).drop("url")


SQL["op4_warc"] = """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS low FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> low THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> low THEN low END AS refers_to
FROM f
"""


@_query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, its source's size and target."""
    return mixing.taken_words(load(spark, sf_dir, "documents", ["doc_id", "text", "source"]))


@_query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pre-tokens, tokens and best unigram score of every document."""
    return token_counts.token_counts(load(spark, sf_dir, "documents", ["doc_id", "text"]), public_tokenizer("piece_bpe_32k.model"))


@_query
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document (3-word shingles) and its component over links of at most 3 bits."""
    found = simhash.near_duplicates(simhash.fingerprints(load(spark, sf_dir, "documents", ["doc_id", "text"]), shingle=3), max_bits=3)
    return found.select("doc_id", simhash.hexadecimal("fp").alias("fingerprint"), "component_id")


@_query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids (end id 2) through bit-packed files and back."""
    return token_store.token_ids(spark, load(spark, sf_dir, "documents", ["doc_id", "text"]), public_tokenizer(), end_id=2)


@_query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the labelled rows that aren't held out."""
    found, name = toxicity.scored(load(spark, sf_dir, "documents", ["doc_id", "text"]), load(spark, sf_dir, "labels", ["doc_id", "toxic"]))
    return found.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col(name).alias("score"),
                        (F.col(name) >= toxicity.PREDICTED).cast("int").alias("predicted"))


@_query
def op10_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every vec_id divisible by 20."""
    rows = hnsw.valid(load(spark, sf_dir, "embeddings", ["vec_id", "embedding"]))
    return hnsw.nearest(hnsw.build_index(rows, k=20), rows.where("id % 20 = 0"), k=20)


@_query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the prefix trie of all rebuilt conversations."""
    turns = prefix_trie.ordered_turns(load(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"]))
    return prefix_trie.trie(*prefix_trie.rebuilt(turns))


SQL["op11_prefix_trie"] = r"""
WITH crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
           lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS steps
), named AS (
    SELECT conv_id AS c, turn, length(coalesce(text, '')) AS chars,
           sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, '')) AS t
    FROM conversations WHERE conv_id IS NOT NULL
), turns AS (SELECT c, t, chars, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, t) AS r FROM named
), convs AS (
    SELECT c, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                              lambda a, b: xor(a >> 8, steps[(xor(a, b) & 255) + 1])), 4294967295) % 6 AS h
    FROM (SELECT DISTINCT c FROM turns), crc
), rows AS (
    SELECT v.c, 0 AS part, r, t, chars FROM convs v JOIN turns b ON b.c = v.c - v.c % 100 AND b.r <= v.h
    UNION ALL SELECT v.c, 1, r, t, chars FROM convs v JOIN turns o ON o.c = v.c AND o.r > v.h
), placed AS (SELECT c, t, chars, row_number() OVER (PARTITION BY c ORDER BY part, r) AS d FROM rows
), paths AS (
    SELECT c, d, sha256(string_agg(t, ',') OVER (PARTITION BY c ORDER BY d)) AS node, chars FROM placed
    UNION ALL SELECT c, 0, 'root', 0 FROM convs
), nodes AS (SELECT node, d, min(c) AS c, count(*) AS n, any_value(chars) AS chars FROM paths GROUP BY node, d
), up AS (SELECT u.node, m.c AS parent, p.node AS parent_node FROM nodes u JOIN paths p ON p.c = u.c AND p.d = u.d - 1 JOIN nodes m ON m.node = p.node
), kids AS (SELECT parent_node AS node, count(*) AS n_children FROM up GROUP BY ALL
), totals AS (
    SELECT p.node, sum(CASE WHEN k.node IS NULL THEN 1 ELSE 0 END) AS leaves, sum((u.n - 1) * u.chars) AS saved
    FROM nodes u JOIN paths p ON p.c = u.c AND p.d <= u.d LEFT JOIN kids k ON k.node = u.node GROUP BY p.node
), last AS (SELECT c, max(d) AS d FROM paths GROUP BY c
), ends AS (SELECT p.node, sha256(string_agg(CAST(p.c AS VARCHAR), ',' ORDER BY p.c)) AS ends FROM paths p JOIN last USING (c, d) GROUP BY p.node)
SELECT n.c AS conv_id, n.d AS depth, up.parent AS parent_conv_id, n.n AS n_convs, coalesce(n_children, 0) AS n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM nodes n JOIN totals USING (node) LEFT JOIN up USING (node) LEFT JOIN kids USING (node) LEFT JOIN ends USING (node)
"""


@_query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut at two unit ends and put around the markers, and back again."""
    found, name = fill_in_middle.fill_in_middle(load(spark, sf_dir, "documents", ["doc_id", "text"]))
    made = F.col(name)
    back = fill_in_middle.restored(made["output"], made["form"])
    return found.select("doc_id", f"{name}.n", f"{name}.form", f"{name}.prefix_chars", f"{name}.middle_chars",
                        F.sha2(made["output"], 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


SQL["op12_fill_in_middle"] = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
    FROM documents
), c AS (
    SELECT doc_id, t, units, len(units) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(units) + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (len(units) + 1) AS b,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 50 THEN 'plain'
                WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM d
), p AS (
    SELECT doc_id, t, n, form, array_to_string(units[1:least(a, b)], '') AS pre, array_to_string(units[least(a, b) + 1:greatest(a, b)], '') AS mid,
           array_to_string(units[greatest(a, b) + 1:], '') AS suf
    FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CAST(CASE WHEN form <> 'plain' THEN length(pre) END AS BIGINT) AS prefix_chars,
       CAST(CASE WHEN form <> 'plain' THEN length(mid) END AS BIGINT) AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(pre || mid || suf) AS restored_sha256
FROM p
"""


@_query
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of texts that are equal but for blanks, through the stateful stream."""
    found = exact_dedup.deduplicated(spark, exact_dedup.stream_of(table_path(sf_dir, "documents")))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


SQL["op13_exact_dedup"] = r"""
WITH n AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS c FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY c) AS group_size, row_number() OVER w = 1 AS kept, sha256(c) AS text_sha256
FROM n WINDOW w AS (PARTITION BY c ORDER BY length(t) DESC, doc_id NULLS LAST)
"""
