"""The registered queries of this subpackage: one per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookflow.llm import ann, bpe, decontaminate, langid, linededup, minhash, packing, repair, tokenids, toxicity, trie, urlfilter, warc
from brookflow.llm.common import table
from brookflow.llm.tokens import default_path


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(spark, table(spark, sf_dir, "pages"))


OP1_SQL = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), w AS (SELECT payload_digest, max(page_id) AS responds FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, p.payload_digest, CASE WHEN page_id < responds THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < responds THEN responds END AS refers_to
FROM p LEFT JOIN w ON p.payload_digest = w.payload_digest
"""


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), every=100, k=10)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's labelled outcome is the quality of the row of labels whose id is the page's: 0 is bad."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad"))
    return urlfilter.judge_urls(table(spark, sf_dir, "pages"), labels).drop("bad_bound")


OP3_SQL = """
WITH urls AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM urls
), ruled AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/7%' THEN 'example.com/en/7'
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/de/8%' THEN 'example.net/de/8'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/en/%' THEN 'com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/de/%' THEN 'net/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/es/%' THEN 'org/es/' END AS rule
  FROM parts
), hosts AS (
  SELECT host, count(*) AS n, CAST(sum(1 - l.quality) AS BIGINT) AS bad
  FROM parts p JOIN labels l ON p.page_id = l.doc_id WHERE l.quality IS NOT NULL AND host <> '' GROUP BY host
), h AS (
  SELECT *, CASE WHEN len(string_split(host, '.')) <= 2 THEN host ELSE string_split(host, '.')[-2] || '.' || string_split(host, '.')[-1] END AS domain,
         string_split(host, '.')[-1] AS suffix FROM hosts
), d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY domain, suffix
), s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY suffix
), w AS (SELECT (sum(bad) + 1.0::DOUBLE) / (sum(n) + 2.0::DOUBLE) AS prior FROM s
), s0 AS (SELECT s.*, prior, n * (bad / n::DOUBLE - prior) ^ 2 AS e FROM s, w
), sm AS (SELECT (sum(e) - sum(prior * (1 - prior))) / nullif(sum(prior * (1 - prior) * (n - 1)), 0) AS rho FROM s0
), s1 AS (SELECT suffix, k, (prior * k + bad) / (k + n) AS prior_of FROM s0, (SELECT greatest(2, least(1000, CASE WHEN rho > 0 THEN 1 / rho - 1 ELSE 1000 END)) AS k FROM sm)
), d0 AS (SELECT d.*, prior_of AS prior, n * (bad / n::DOUBLE - prior_of) ^ 2 AS e FROM d JOIN s1 USING (suffix)
), dm AS (SELECT (sum(e) - sum(prior * (1 - prior))) / nullif(sum(prior * (1 - prior) * (n - 1)), 0) AS rho FROM d0
), d1 AS (SELECT domain, k, (prior * k + bad) / (k + n) AS prior_of FROM d0, (SELECT greatest(2, least(1000, CASE WHEN rho > 0 THEN 1 / rho - 1 ELSE 1000 END)) AS k FROM dm)
), h0 AS (SELECT h.*, prior_of AS prior, n * (bad / n::DOUBLE - prior_of) ^ 2 AS e FROM h JOIN d1 USING (domain)
), hm AS (SELECT (sum(e) - sum(prior * (1 - prior))) / nullif(sum(prior * (1 - prior) * (n - 1)), 0) AS rho FROM h0
), h1 AS (SELECT host, n, k, (prior * k + bad) / (k + n) AS mean FROM h0, (SELECT greatest(2, least(1000, CASE WHEN rho > 0 THEN 1 / rho - 1 ELSE 1000 END)) AS k FROM hm)
), strengths AS (SELECT (SELECT any_value(k) FROM h1) AS kh, (SELECT any_value(k) FROM d1) AS kd, (SELECT any_value(k) FROM s1) AS ks
), shares AS (
  SELECT kh, kd, ks, 1 / (kh + 1) AS under_domain, 1 / (kd + 1) + kd / (kd + 1) / (kh + 1) AS under_suffix,
         1 / (ks + 1) + ks / (ks + 1) * (1 / (kd + 1) + kd / (kd + 1) / (kh + 1)) AS under_all FROM strengths
), bounds AS (
  SELECT 0 AS level, host AS name, mean - 1.645 * sqrt(mean * (1 - mean) / (k + n + 1)) AS bound FROM h1
  UNION ALL SELECT 1, domain, prior_of - 1.645 * sqrt(prior_of * (1 - prior_of) * under_domain) FROM d1, shares
  UNION ALL SELECT 2, suffix, prior_of - 1.645 * sqrt(prior_of * (1 - prior_of) * under_suffix) FROM s1, shares
  UNION ALL SELECT 3, '', prior - 1.645 * sqrt(prior * (1 - prior) * under_all) FROM w, shares
), names AS (
  SELECT DISTINCT host, unnest([0, 1, 2, 3]) AS level,
         unnest([host, array_to_string(string_split(host, '.')[-2:], '.'), string_split(host, '.')[-1], '']) AS name FROM parts WHERE host <> ''
), nearest AS (SELECT host, arg_min(bound, level) AS bound FROM names JOIN bounds USING (level, name) WHERE bound IS NOT NULL GROUP BY host
), blocked AS (SELECT host FROM nearest WHERE bound > 0.5)
SELECT page_id, ruled.host, path, rule, CASE
  WHEN rule IN ('example.com/en/7', 'net/de/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN blocked.host IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM ruled LEFT JOIN blocked ON ruled.host = blocked.host
"""


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("__lines").cast("long").alias("n_lines"), F.col("__removed").cast("long").alias("n_removed"), "text")


OP4_SQL = """
WITH split AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents
), lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos FROM split
), runs AS (
  SELECT doc_id, pos, line AS a, lead(line, 1) OVER d AS b, lead(line, 2) OVER d AS c FROM lines WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
), wins AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) AS nth FROM runs
  WHERE b IS NOT NULL AND c IS NOT NULL AND NOT (trim(a, ' ') = '' AND trim(b, ' ') = '' AND trim(c, ' ') = '')
), gone AS (SELECT DISTINCT doc_id, pos + k AS pos FROM wins, (SELECT unnest([0, 1, 2]) AS k) WHERE nth > 1
), kept AS (
  SELECT lines.doc_id, coalesce(string_agg(line, chr(10) ORDER BY lines.pos) FILTER (WHERE gone.pos IS NULL), '') AS text, count(gone.pos) AS n_removed
  FROM lines LEFT JOIN gone ON lines.doc_id = gone.doc_id AND lines.pos = gone.pos GROUP BY lines.doc_id)
SELECT s.doc_id, CAST(coalesce(len(s.l), 0) AS BIGINT) AS n_lines, coalesce(k.n_removed, 0) AS n_removed, CASE WHEN s.text IS NULL THEN NULL ELSE k.text END AS text
FROM split s LEFT JOIN kept k ON s.doc_id = k.doc_id
"""


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), least_percent=85).select("doc_id", "n_shingles", "component_id", "kept")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(spark, table(spark, sf_dir, "documents"), default_path(), capacity=2048, end_id=0)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Every pair of equal words of a text and an item, by diagonal; then every window of the diagonals that agree enough.
OP8_SQL = """
WITH tw AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos
  FROM (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents WHERE doc_id IS NOT NULL)
), iw AS (
  SELECT item_id, len(w) AS n, unnest(w) AS word, unnest(range(len(w))) AS pos
  FROM (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM benchmark)
), same AS (SELECT doc_id, item_id, n, tw.pos - iw.pos AS d, iw.pos AS p FROM tw JOIN iw USING (word)
), close AS (
  SELECT doc_id, item_id, n, d, list(p) AS places, least(n, 20) AS size, CASE WHEN n < 8 THEN 100 ELSE 80 END AS percent FROM same GROUP BY doc_id, item_id, n, d
  HAVING 100 * count(*) >= CASE WHEN n < 8 THEN 100 ELSE 80 END * least(n, 20)
), wins AS (
  SELECT doc_id, item_id, d, s, size, percent, len(list_filter(places, lambda p: p >= s AND p < s + size)) AS agree
  FROM (SELECT *, unnest(range(n - size + 1)) AS s FROM close)
), best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY agree DESC, s + d) AS k FROM wins WHERE 100 * agree >= percent * size)
SELECT doc_id, item_id, CAST(s + d AS INTEGER) AS at_word, CAST(size AS INTEGER) AS n_words, CAST(agree AS INTEGER) AS n_same FROM best WHERE k = 1
"""


def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenids.token_ids(spark, table(spark, sf_dir, "documents"), default_path(), end_id=2)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.round_trip(table(spark, sf_dir, "documents"), default_path()))


#: crc32 of an ASCII text in SQL: the table of the 256 bytes, and its use byte by byte.
_CRC_TABLE = "SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc"


def _crc32(text: str) -> str:
    letters = f"list_transform(range(1, length({text}) + 1), lambda i: CAST(ascii({text}[i]) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {letters}), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295)"


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair.repair_report(conversations, repair.damaged(conversations))


def _more(cost: str, letter: str, value: str) -> str:
    """A way is its cost in nine digits and its edits: the least text is the cheapest way and of those the least."""
    return f"lpad(CAST(CAST(left({value}, 9) AS INTEGER) + {cost} AS VARCHAR), 9, '0') || '{letter}' || substr({value}, 10)"


def _way(state: int) -> str:
    """The least way from a state on, with one row done: delete, keep where the row's initial fits, or change its role."""
    step, keeps = (2, 2, 3, 2)[state], {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[state]
    kept = " ".join(f"WHEN initial = '{c}' THEN {_more('late', 'K', f'v{q}')}" for c, q in keeps.items())
    return f"least({_more('4', 'D', f'v{state}')}, CASE WHEN must THEN NULL {kept} END, CASE WHEN NOT must THEN {_more('3 + late', 'R', f'v{step}')} END)"


OP12_SQL = f"""
WITH RECURSIVE tab AS ({_CRC_TABLE}
), keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') AS cid,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
), harmed AS (SELECT keyed.*, {_crc32("k")} % 20 AS harm FROM keyed, tab
), damaged AS (
  SELECT cid, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role, CASE harm WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM harmed, (SELECT unnest([1, 2]) AS copy) WHERE harm <> 0 AND (copy = 1 OR harm = 3)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY cid ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM damaged
), judged AS (
  SELECT *, left(role, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS seen,
         row_number() OVER (PARTITION BY cid, role, text ORDER BY i) AS nth, left(role, 1) || lead(left(role, 1)) OVER (PARTITION BY cid ORDER BY i) AS pair FROM ranked
), rows AS (
  SELECT cid, i, turn, role, text, initial, pair, seen = '' AS blank, seen <> '' AND nth > 1 AS again, seen <> '' AND nth = 1 AND right(seen, 1) NOT IN ('.', '!', '?') AS short,
         seen = '' OR nth > 1 AS must, CASE WHEN right(seen, 1) IN ('.', '!', '?') THEN 0 ELSE 3 END AS late FROM judged
), stats AS (
  SELECT cid, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE again) AS duplicate,
         count(*) FILTER (WHERE short) AS truncated, count(*) FILTER (WHERE i < n AND coalesce(pair, '') NOT IN ('su', 'ua', 'au')) AS illegal, max(n) AS n
  FROM (SELECT *, count(*) OVER (PARTITION BY cid) AS n FROM rows) GROUP BY cid
), ways AS (
  SELECT cid, n AS i, '000000000' AS v0, '000000006II' AS v1, '000000003I' AS v2, '000000000' AS v3 FROM stats
  UNION ALL
  SELECT cid, i - 1, least(b0, {_more('3', 'I', 'c2')}), least(b1, {_more('3', 'I', 'c2')}), c2, c3
  FROM (SELECT *, least(b2, {_more('3', 'I', 'b3')}) AS c2, least(b3, {_more('3', 'I', 'b2')}) AS c3
        FROM (SELECT w.cid, w.i, {_way(0)} AS b0, {_way(1)} AS b1, {_way(2)} AS b2, {_way(3)} AS b3 FROM ways w JOIN rows r ON w.cid = r.cid AND w.i = r.i))
), found AS (SELECT cid, CAST(left(v0, 9) AS BIGINT) AS cost, substr(v0, 10) AS audit FROM ways WHERE i = 0
), letters AS (SELECT cid, unnest(string_split(audit, '')) AS letter, unnest(range(1, length(audit) + 1)) AS p FROM found WHERE audit <> ''
), placed AS (SELECT *, count(*) FILTER (WHERE letter <> 'I') OVER (PARTITION BY cid ORDER BY p) AS i FROM letters
), edits AS (
  SELECT e.cid, letter, role, text, initial, row_number() OVER (PARTITION BY e.cid ORDER BY p) AS place
  FROM placed e LEFT JOIN rows r ON e.cid = r.cid AND e.i = r.i AND letter <> 'I' WHERE letter <> 'D'
), mended AS (
  SELECT *, max(CASE WHEN place = 1 AND letter = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY cid) AS led FROM edits
), hashed AS (
  SELECT cid, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY place)) AS digest
  FROM mended GROUP BY cid
)
SELECT k.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, cid FROM keyed) k LEFT JOIN stats USING (cid) LEFT JOIN found USING (cid) LEFT JOIN hashed USING (cid)
"""


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations")).drop("node", "parent")


OP13_SQL = f"""
WITH RECURSIVE tab AS ({_CRC_TABLE}
), t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS p FROM conversations WHERE conv_id IS NOT NULL
), ids AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS k FROM t
), c AS (SELECT conv_id, {_crc32("k")} % 6 AS h FROM ids, tab
), r AS (
  SELECT c.conv_id, 0 AS own, p, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND p <= h
  UNION ALL SELECT c.conv_id, 1, p, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND p > h
), s AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY own, p) AS d FROM r
), m AS (
  SELECT conv_id, d, length(text) AS points, sha256(string_agg(sha256(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY d)) AS node FROM s
), l AS (
  SELECT conv_id, d, points, node, coalesce(lag(node) OVER (PARTITION BY conv_id ORDER BY d), 'root') AS parent FROM m
  UNION ALL SELECT conv_id, 0, 0, 'root', NULL FROM ids
), e AS (SELECT *, d = max(d) OVER (PARTITION BY conv_id) AS last FROM l
), n AS (
  SELECT node, min(conv_id) AS conv_id, any_value(d) AS depth, any_value(parent) AS parent, count(*) AS n_convs, any_value(points) AS points,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256 FROM e GROUP BY node
), b AS (SELECT parent AS node, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent
), up AS (
  SELECT node, node AS top, parent AS further FROM n UNION ALL SELECT up.node, up.further, n.parent FROM up JOIN n ON n.node = up.further
), sums AS (
  SELECT top AS node, CAST(sum((n_convs - 1) * points) AS BIGINT) AS saved_tokens, count(*) FILTER (WHERE b.node IS NULL) AS n_leaves
  FROM up JOIN n ON n.node = up.node LEFT JOIN b ON b.node = up.node GROUP BY top
)
SELECT n.conv_id, n.depth, above.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM n JOIN sums USING (node) LEFT JOIN b USING (node) LEFT JOIN n above ON above.node = n.parent
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc": op1_warc,
        "op2_nearest": op2_nearest,
        "op3_url_filter": op3_url_filter,
        "op4_line_dedup": op4_line_dedup,
        "op5_minhash": op5_minhash,
        "op6_best_fit_packing": op6_best_fit_packing,
        "op7_language_id": op7_language_id,
        "op8_decontaminate": op8_decontaminate,
        "op9_token_ids": op9_token_ids,
        "op10_toxicity": op10_toxicity,
        "op11_bpe": op11_bpe,
        "op12_structure_repair": op12_structure_repair,
        "op13_prefix_trie": op13_prefix_trie,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": OP1_SQL, "op3_url_filter": OP3_SQL, "op4_line_dedup": OP4_SQL, "op8_decontaminate": OP8_SQL, "op12_structure_repair": OP12_SQL, "op13_prefix_trie": OP13_SQL}
