"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

#: Host labels of the listed pages.
URL_LISTED_HOSTS = ("spam-farm", "cheap-pills", "casino-win")

OP2 = f"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
  FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), spelled AS (
  SELECT *, CASE WHEN host <> '' THEN
      regexp_replace(regexp_replace(host, '(:80|:443)$', ''), '^(www|m)\\.', '')
      || regexp_replace(regexp_replace(path, '\\.html$', ''), '/+$', '') END AS canonical
  FROM parts
), listing AS (
  SELECT DISTINCT canonical FROM spelled
  WHERE regexp_matches(host, '({'|'.join(URL_LISTED_HOSTS)})[.]') AND canonical IS NOT NULL
), rules(rule, rule_host, rule_path, said) AS (
  VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
         ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
         ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')
), fits AS (
  SELECT s.page_id, s.host, s.path, s.canonical, rule, said,
         row_number() OVER (PARTITION BY s.page_id ORDER BY length(rule) DESC) AS place
  FROM spelled s LEFT JOIN rules
    ON (s.host = rule_host OR s.host LIKE '%.' || rule_host) AND starts_with(s.path, rule_path)
)
SELECT f.page_id, host, path, rule,
       coalesce(said, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       f.canonical, l.canonical IS NOT NULL AS listed
FROM fits f LEFT JOIN listing l ON f.canonical = l.canonical
WHERE place = 1
"""


def _bid(shard: int) -> str:
    drawn = f"CAST('0x' || substr(md5(doc_id || '/{shard}'), 1, 13) AS BIGINT)"
    return f"{{'bid': 1.0 / -ln(({drawn} + 0.5) / 4503599627370496.0), 'shard': {-shard}}}"


def _best(shards: int) -> str:
    return f"-greatest({', '.join(map(_bid, range(shards)))}).shard"


#: The checksum's table comes from its polynomial; texts are folded byte by byte.
OP4 = f"""
WITH steps AS (
  SELECT list(c ORDER BY n) AS t FROM (
    SELECT n, list_reduce(list_prepend(n, range(8)),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) AS r(n))
), bytes AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0) AS n, hex(encode(coalesce(text, ''))) AS h
  FROM documents
), sums AS (
  SELECT doc_id, n + 1 AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(n),
        lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM bytes, steps
), placed AS (
  SELECT doc_id, size, text_crc32, 'key' AS law, CAST({_best(16)} AS INT) AS shard,
         CAST({_best(17)} AS INT) AS grown_shard
  FROM sums
)
SELECT *, row_number() OVER (PARTITION BY shard ORDER BY doc_id, size, text_crc32) - 1 AS slot FROM placed
"""


OP7 = r"""
WITH body AS (
  SELECT doc_id, coalesce(source, chr(0)) AS host, coalesce(text, '') AS text FROM documents
), word AS (
  SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS w FROM body
), line AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS l FROM body
), windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM word WHERE len(w) >= 3
), counted AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM windows
), covered AS (
  SELECT doc_id, count(DISTINCT j) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM counted WHERE n > 1) GROUP BY doc_id
), base AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM body JOIN word USING (doc_id) JOIN line USING (doc_id) LEFT JOIN covered USING (doc_id)
), short AS (
  SELECT doc_id, host, text,
    regexp_replace(regexp_replace(translate(trim(x, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\x0B\f\r]+', ' ', 'g'), '[0-9]', '0', 'g') AS plain,
    length(regexp_replace(x, '[ \t\x0B\f\r]+', '', 'g')) AS chars
  FROM (SELECT doc_id, host, text, unnest(l) AS x FROM body JOIN line USING (doc_id))
), frequent AS (
  SELECT host, plain FROM short GROUP BY host, plain HAVING count(DISTINCT text) > 20
), lost AS (
  SELECT doc_id, CAST(sum(chars) AS BIGINT) AS lost_chars FROM short JOIN frequent USING (host, plain) GROUP BY doc_id
), judged AS (
  SELECT base.*, coalesce(lost_chars, 0) AS lost_chars,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM base LEFT JOIN lost USING (doc_id)
)
SELECT *, NOT base_failed AND lost_chars <= 0.5 * word_chars AS kept FROM judged
"""


OP9 = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, d.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * d.v[i])) AS BIGINT) AS score
  FROM usable q JOIN usable d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


OP11 = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, d.vec_id, a.label = d.label AS same,
         CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * d.v[i])) AS BIGINT) AS score
  FROM usable a JOIN usable d ON a.vec_id <> d.vec_id WHERE a.vec_id % 50 = 0
), positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 3
"""


def oracles() -> dict[str, str]:
    return {"op2_url_filter": OP2, "op4_rendezvous_shards": OP4, "op7_quality_rules": OP7,
            "op9_dual_tree_topk": OP9, "op11_bond_negatives": OP11}
