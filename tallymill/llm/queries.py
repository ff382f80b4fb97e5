"""The registered queries over the corpus tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymill.llm import (
    bpe_codec, html_text, line_quality, mixing, prefix_hashes, prefix_trie, simhash, source_audit, suffix_dedup, token_counts,
    topk_search, url_filters, warc,
)
from tallymill.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(make):
        QUERIES[name] = make
        if oracle is not None:
            ORACLES[name] = oracle
        return make

    return add


@query("op1_line_quality")
def op1_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    return line_quality.quality(table(spark, folder, "documents"), table(spark, folder, "labels"), threshold=0.7)


@query("op2_mixing")
def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixture(table(spark, folder, "documents"))


@query("op3_simhash")
def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), shingle=3, distance=2)
    return found.select("doc_id", "fingerprint", "component_id")


@query("op4_html_text")
def op4_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extracted(table(spark, folder, "pages"))


@query("op5_token_counts")
def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), limit=1024)


@query(
    "op6_topk_search",
    """
    WITH parts AS (
      SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i
      FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL),
    usable AS (
      SELECT vec_id, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS v FROM parts
      WHERE vec_id NOT IN (SELECT vec_id FROM parts WHERE x IS NULL OR NOT isfinite(x))),
    scores AS (
      SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.v * c.v) AS BIGINT) AS score
      FROM usable q JOIN usable c ON q.i = c.i AND q.vec_id <> c.vec_id
      WHERE q.vec_id % 50 = 0 GROUP BY q.vec_id, c.vec_id)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
    WHERE rank <= 5
    """,
)
def op6_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    return topk_search.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


@query(
    "op7_suffix_dedup",
    """
    WITH docs AS (
      SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b, strlen(coalesce(text, '')) AS n FROM documents),
    marks AS (
      SELECT r, s, md5(array_slice(b, s, s + 199)) AS m FROM (SELECT r, b, unnest(range(1, n - 198)) AS s FROM docs WHERE n >= 200)),
    often AS (SELECT m FROM marks GROUP BY m HAVING count(*) > 1),
    hits AS (SELECT r, s FROM marks WHERE m IN (SELECT m FROM often)),
    -- Strings that overlap or touch make one run.
    runs AS (
      SELECT r, min(s) AS low, max(s) + 199 AS high
      FROM (SELECT r, s, sum(new) OVER (PARTITION BY r ORDER BY s) AS run
            FROM (SELECT r, s, CASE WHEN s <= lag(s) OVER (PARTITION BY r ORDER BY s) + 200 THEN 0 ELSE 1 END AS new FROM hits))
      GROUP BY r, run),
    edges AS (
      SELECT r, low, high FROM runs UNION ALL SELECT r, n + 1, n + 1 FROM docs),
    pieces AS (
      SELECT r, low, coalesce(lag(high) OVER (PARTITION BY r ORDER BY low, high), 0) + 1 AS from_byte, low - 1 AS to_byte FROM edges),
    kept AS (
      SELECT r, string_agg(CASE WHEN to_byte >= from_byte THEN hex(array_slice(b, from_byte, to_byte)) ELSE '' END, '' ORDER BY low) AS bytes
      FROM pieces JOIN docs USING (r) GROUP BY r),
    removed AS (SELECT r, sum(high - low + 1) AS n_removed, count(*) AS n_spans FROM runs GROUP BY r)
    SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
           sha256(unhex(bytes)) AS kept_sha256
    FROM docs JOIN kept USING (r) LEFT JOIN removed USING (r)
    """,
)
def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.removed(table(spark, folder, "documents"), length=200)


@query(
    "op8_warc",
    """
    WITH payloads AS (
      SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages)
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest,
           CASE WHEN n >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN n >= 100 AND first <> page_id THEN first END AS refers_to
    FROM (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM payloads)
    """,
)
def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


@query("op9_prefix_hashes")
def op9_prefix_hashes(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_hashes.compared(table(spark, folder, "documents"))


@query("op10_bpe_codec")
def op10_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_codec.digests(table(spark, folder, "documents"))


@query(
    "op11_source_audit",
    r"""
    WITH docs AS (
      SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
      FROM documents),
    words AS (
      SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
    kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
    langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
    groups AS (SELECT DISTINCT lang, source FROM docs),
    counts AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY lang, source, term),
    grid AS (
      SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n,
             sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
      FROM groups g JOIN kept k ON k.lang = g.lang
      LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    shares AS (
      SELECT lang, source, term, n,
             1 + CAST(1000000000 AS HUGEINT) * (n + 5) // (grid.total + 5 * v) AS p,
             1 + CAST(1000000000 AS HUGEINT) * (lang_n + 5) // (langs.total + 5 * v) AS q
      FROM grid JOIN langs USING (lang)),
    found AS (
      SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
             coalesce(d.value, 0) AS value
      FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN (
        SELECT x.lang, x.source, y.source AS other, sum(abs(x.p - y.p)) AS value
        FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
        GROUP BY x.lang, x.source, y.source) d
      ON d.lang = a.lang AND d.source = a.source AND d.other = b.source
      UNION ALL
      SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q)
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
    FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
    WHERE part = 'pair' OR rank <= 50
    """,
)
def op11_source_audit(spark: SparkSession, folder: str) -> DataFrame:
    return source_audit.divergence(table(spark, folder, "documents"), least_docs=30, top=50)


@query(
    "op12_prefix_trie",
    """
    WITH own AS (
      SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST) AS turns
      FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations)
      WHERE conv_id IS NOT NULL GROUP BY conv_id),
    -- CRC-32 of the decimal id, bit by bit.
    checks AS (
      SELECT conv_id, xor(4294967295, list_reduce(
               list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
               lambda crc, byte: list_reduce(
                 list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]),
                 lambda x, bit: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))) % 9 AS h
      FROM own),
    rebuilt AS (
      SELECT o.conv_id, list_concat(coalesce(b.turns[1:h], []), o.turns[h + 1:]) AS path
      FROM own o JOIN checks USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5),
    prefixes AS (
      SELECT conv_id, len(path) AS n, unnest(range(0, len(path) + 1)) AS depth, path FROM rebuilt),
    nodes AS (
      SELECT path[1:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256,
             (count(*) - 1) * CASE WHEN depth > 0 THEN strlen(any_value(path[depth].text)) ELSE 0 END AS saved
      FROM prefixes GROUP BY path[1:depth], depth),
    children AS (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY node[1:depth - 1]),
    below AS (
      SELECT n.node, n.saved, n.depth, coalesce(c.n_children, 0) = 0 AS is_leaf FROM nodes n LEFT JOIN children c ON c.node = n.node),
    subtrees AS (
      SELECT node[1:d] AS node, sum(saved) AS saved_tokens, count(*) FILTER (WHERE is_leaf) AS n_leaves
      FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM below) GROUP BY node[1:d])
    SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, s.n_leaves,
           CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
    FROM nodes n JOIN subtrees s ON s.node = n.node LEFT JOIN children c ON c.node = n.node
    LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.node[1:n.depth - 1]
    """,
)
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(table(spark, folder, "conversations"), every=5, shared_turns=9)


URL_RULES = [
    url_filters.Rule.parse("allow", "org/"),
    url_filters.Rule.parse("block", "example.org/es/"),
    url_filters.Rule.parse("block", "example.org/en/1"),
    url_filters.Rule.parse("allow", "com/fr/"),
    url_filters.Rule.parse("block", "com/de/"),
]


@query(
    "op13_url_filters",
    """
    WITH rests AS (
      SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    parts AS (
      SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
    rules(verdict, rule_host, rule_path) AS (
      VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
             ('allow', 'com', '/fr/'), ('block', 'com', '/de/'))
    SELECT page_id, host, path,
           (SELECT rule_host || rule_path FROM rules WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            ORDER BY length(rule_host || rule_path) DESC LIMIT 1) AS rule,
           coalesce((SELECT verdict FROM rules WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            ORDER BY length(rule_host || rule_path) DESC LIMIT 1), 'allow') AS verdict
    FROM parts
    """,
)
def op13_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_filters.judged(table(spark, folder, "pages"), URL_RULES)
