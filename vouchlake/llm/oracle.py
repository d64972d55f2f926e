"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT)"

MIX = rf"""
WITH docs AS (
  SELECT doc_id, source, {_WORDS} AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source
), weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sources
), levels AS (
  SELECT *,
    CAST(3 * sum(source_size) OVER () - 4 * coalesce(sum(source_size) OVER before, 0) AS BIGINT) AS rest,
    CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS BIGINT) AS by_weight
  FROM weighed
  WINDOW before AS (
    ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT max({{'by_weight': by_weight, 'rest': rest}}) AS lev FROM levels
  WHERE weight * rest <= 4 * source_size * by_weight
), targets AS (
  SELECT source, source_size,
    CASE WHEN weight * rest <= 4 * source_size * by_weight
      THEN CAST(weight * lev.rest AS DOUBLE) / CAST(2 * lev.by_weight AS DOUBLE)
      ELSE CAST(2 * source_size AS DOUBLE) END AS target
  FROM levels, level
), placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
    CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id NULLS FIRST, d.size
      ROWS UNBOUNDED PRECEDING) AS BIGINT) - d.size AS start
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CAST(CASE WHEN source_size = 0 THEN 0 ELSE
    budget // source_size * size + least(greatest(budget % source_size - start, 0), size) END AS BIGINT) AS taken
FROM placed
"""

TOKEN_COUNTS = r"""
WITH numbered AS (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS n FROM documents
)
SELECT source, lang, 'words-2' AS tokenizer, count(*) AS n_docs,
  CAST(sum(coalesce(len(regexp_extract_all(text, '[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]')), 0)) AS BIGINT) AS n_tokens
FROM numbered WHERE text IS NULL OR n = 1 GROUP BY source, lang
"""


def _located(pattern: str, group: int, least: int, kind: str, k: int) -> str:
    return f"""
  SELECT row_id, {k} AS k, '{kind}' AS kind, hit, pos - len(whole) AS start_at, pos AS end_at FROM (
    SELECT row_id, whole, hit, sum(len(gap) + len(whole)) OVER (PARTITION BY row_id ORDER BY i) AS pos FROM (
      SELECT row_id, generate_subscripts(whole, 1) AS i, unnest(whole) AS whole, unnest(hit) AS hit,
        unnest(gap[:len(whole)]) AS gap
      FROM (SELECT row_id, regexp_extract_all(text, '{pattern}') AS whole, regexp_extract_all(text, '{pattern}', {group}) AS hit,
        string_split_regex(text, '{pattern}') AS gap FROM texts)))
  WHERE len(hit) >= {least}"""


def _hot(kind: str, k: int, one: str, window: int, bits: float) -> str:
    from vouchlake.llm.secrets import ALLOWED

    allowed = "|".join(ALLOWED)
    return f"""
  SELECT row_id, {k} AS k, '{kind}' AS kind, '' AS hit, start_at + min(i) AS start_at, start_at + max(i) + {window} AS end_at
  FROM (
    SELECT row_id, start_at, hit, i, hit[i + 1 : i + {window}] AS part
    FROM (SELECT row_id, start_at, hit, unnest(range(len(hit) - {window - 1})) AS i
      FROM ({_located(f"({one}{{{window},}})", 1, window, kind, k)})
      WHERE NOT regexp_full_match(hit, '{allowed}')))
  WHERE list_aggregate(string_split(part, ''), 'entropy') >= {bits} - 1e-9
    AND regexp_matches(part, '[0-9]') AND regexp_matches(part, '[^0-9]')
  GROUP BY row_id, start_at"""


def secret_scan() -> str:
    from vouchlake.llm.secrets import BASE, CLASSES

    parts = [_located(p.replace("'", "''"), g, least, kind, k) for k, (kind, (p, g, least)) in enumerate(BASE.items())]
    parts += [_hot(c.kind, len(BASE) + k, c.pattern, c.window, c.bits) for k, c in enumerate(CLASSES)]
    listed = "string_agg(kind || ':' || CAST(start_at AS BIGINT) || ':' || CAST(end_at AS BIGINT), ',' ORDER BY start_at, k)"
    return f"""
WITH texts AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({" UNION ALL ".join(parts)}),
found AS (
  SELECT row_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex, {listed} FILTER (k < {len(BASE)}) AS base, {listed} AS spans
  FROM spans GROUP BY row_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN found USING (row_id)
"""


LINES = r"""
WITH parted AS (
  SELECT doc_id, generate_subscripts(lines, 1) - 1 AS line_no, unnest(lines) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL)
), sets AS (
  SELECT doc_id, line_no,
    list_sort(list_distinct(list_filter(string_split_regex(lower(line), '[\x20\x09-\x0D]+'), lambda w: w <> ''))) AS words
  FROM parted
), firsts AS (
  SELECT words, len(words) AS n, min({'doc_id': doc_id, 'line_no': line_no}) AS place
  FROM sets WHERE len(words) > 0 GROUP BY words
), gone AS (
  SELECT DISTINCT b.words FROM firsts a JOIN firsts b
    ON a.place < b.place AND a.n * 10 >= b.n * 8 AND b.n * 10 >= a.n * 8
  WHERE len(list_intersect(a.words, b.words)) * 18 >= (a.n + b.n) * 8
), removed AS (
  SELECT s.doc_id, count(*) AS n_removed, string_agg(CAST(s.line_no AS VARCHAR), ',' ORDER BY s.line_no) AS removed
  FROM sets s JOIN firsts f ON s.words = f.words LEFT JOIN gone g ON s.words = g.words
  WHERE g.words IS NOT NULL OR {'doc_id': s.doc_id, 'line_no': s.line_no} > f.place
  GROUP BY s.doc_id
)
SELECT d.doc_id, CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS BIGINT) AS n_lines,
  coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed
FROM documents d LEFT JOIN removed r ON d.doc_id = r.doc_id
"""

_REACH = """reach AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), least_of AS (SELECT x, min(y) AS y FROM reach GROUP BY x)"""

VECTORS = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), {_REACH}
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.x = e.vec_id) AS n_links,
  least(e.vec_id, coalesce(o.y, e.vec_id)) AS component_id, e.vec_id <= coalesce(o.y, e.vec_id) AS kept
FROM embeddings e LEFT JOIN least_of o ON o.x = e.vec_id
"""

NGRAMS = rf"""
WITH RECURSIVE lowered AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3
      THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS gram
  FROM lowered
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 90 * (p.n + q.n - c)
), {_REACH}
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(o.y, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least_of o ON o.x = d.doc_id
"""


# crc_table: the 256 steps of CRC-32, bit by bit.
_CRC_TABLE = """crc_steps AS (
  SELECT b, 0 AS k, b AS step FROM (SELECT unnest(range(256)) AS b)
  UNION ALL
  SELECT b, k + 1, CASE WHEN step % 2 = 1 THEN xor(step >> 1, 3988292384) ELSE step >> 1 END FROM crc_steps WHERE k < 8
), crc_table AS (SELECT list(step ORDER BY b) AS steps FROM crc_steps WHERE k = 8)"""


def _crc32(text: str) -> str:
    return f"""xor(list_reduce(list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT)),
      lambda crc, byte: xor(crc >> 8, steps[CAST(xor(crc, byte) & 255 AS INT) + 1]), 4294967295::BIGINT), 4294967295)"""


def _told(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || {value}, '-')"


_UP = """proof || array_to_string(list_filter(run, lambda d, i: i <> rank % 3 + 1), ''),
    sha256(array_to_string(run[:rank % 3], '') || folded || array_to_string(run[rank % 3 + 2:], ''))"""

MERKLE = f"""
WITH RECURSIVE {_CRC_TABLE}, told AS (
  SELECT doc_id, source, concat({_told("doc_id")}, {_told("source")}, {_told("lang")}, {_told("n_chars")}) AS head,
    {_told("text")} AS tail, {_told("replace(text, chr(10), '')")} AS bare, {_crc32("CAST(doc_id AS VARCHAR)")} AS crc
  FROM documents, crc_table
), leaves AS (
  SELECT doc_id, sha256(head || tail) AS leaf, sha256(head || CASE WHEN crc % 2 = 0 THEN bare ELSE tail END) AS seen,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, sha256(head || tail)) - 1 AS rank
  FROM told
), below AS (
  SELECT tree, 0 AS level, rank, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n FROM leaves
  UNION ALL
  SELECT tree, level + 1, rank // 3, sha256(string_agg(digest, '' ORDER BY rank)), any_value(n + 2) // 3
  FROM below WHERE n > 1 GROUP BY tree, level, rank // 3
), above AS (
  SELECT 0 AS level, tree AS rank, digest, (SELECT count(DISTINCT tree) FROM leaves) AS n FROM below WHERE n = 1
  UNION ALL
  SELECT level + 1, rank // 3, sha256(string_agg(digest, '' ORDER BY rank)), any_value(n + 2) // 3
  FROM above WHERE n > 1 GROUP BY level, rank // 3
), runs AS (
  SELECT tree, level, rank // 3 AS up, list(digest ORDER BY rank) AS run FROM below WHERE n > 1 GROUP BY ALL
), top_runs AS (
  SELECT level, rank // 3 AS up, list(digest ORDER BY rank) AS run FROM above WHERE n > 1 GROUP BY ALL
), walk AS (
  SELECT tree, rank AS leaf_rank, 0 AS level, rank, '' AS proof, seen AS folded FROM leaves
  UNION ALL
  SELECT w.tree, leaf_rank, w.level + 1, rank // 3, {_UP}
  FROM walk w JOIN runs r ON w.tree = r.tree AND w.level = r.level AND w.rank // 3 = r.up
), at_subroot AS (
  SELECT tree, leaf_rank, proof, folded FROM walk QUALIFY row_number() OVER (PARTITION BY tree, leaf_rank ORDER BY level DESC) = 1
), top_walk AS (
  SELECT tree, leaf_rank, 0 AS level, tree AS rank, proof, folded FROM at_subroot
  UNION ALL
  SELECT w.tree, leaf_rank, w.level + 1, rank // 3, {_UP}
  FROM top_walk w JOIN top_runs r ON w.level = r.level AND w.rank // 3 = r.up
), at_root AS (
  SELECT tree, leaf_rank, proof, folded FROM top_walk QUALIFY row_number() OVER (PARTITION BY tree, leaf_rank ORDER BY level DESC) = 1
)
SELECT doc_id, leaf, s.digest AS subroot, t.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
  folded = t.digest AS verified
FROM leaves l JOIN at_root a ON l.tree = a.tree AND l.rank = a.leaf_rank
  JOIN below s ON s.tree = l.tree AND s.n = 1 JOIN above t ON t.n = 1
"""

TRIE = rf"""
WITH RECURSIVE {_CRC_TABLE}, turns AS (
  SELECT conv_id, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
    {_WORDS} AS words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS rank
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT conv_id, {_crc32("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM turns), crc_table
), placed AS (
  SELECT i.conv_id, 0 AS part, t.rank, digest, words FROM ids i JOIN turns t ON t.conv_id = i.conv_id - i.conv_id % 20 AND t.rank < h
  UNION ALL
  SELECT i.conv_id, 1, t.rank, digest, words FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND t.rank >= h
), members AS (
  SELECT conv_id, row_number() OVER so_far AS depth, list(digest) OVER so_far AS prefix, words,
    count(*) OVER (PARTITION BY conv_id) AS size
  FROM placed WINDOW so_far AS (PARTITION BY conv_id ORDER BY part, rank ROWS UNBOUNDED PRECEDING)
  UNION ALL
  SELECT conv_id, 0, CAST([] AS VARCHAR[]), 0, (SELECT count(*) FROM placed p WHERE p.conv_id = i.conv_id) FROM ids i
), nodes AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256,
    bool_and(size = depth) AS leaf
  FROM members GROUP BY prefix, depth
), below AS (
  SELECT a.prefix, count(*) FILTER (n.leaf) AS n_leaves, CAST(sum((n.n_convs - 1) * n.words) AS BIGINT) AS saved_tokens
  FROM nodes n JOIN members a ON a.conv_id = n.conv_id AND a.depth <= n.depth GROUP BY a.prefix
), children AS (SELECT prefix[:depth - 1] AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens,
  n.ends_sha256
FROM nodes n JOIN below b USING (prefix) LEFT JOIN children c USING (prefix)
  LEFT JOIN nodes p ON n.depth > 0 AND p.prefix = n.prefix[:n.depth - 1]
"""


def statements() -> dict[str, str]:
    return {
        "op1_mix_sources": MIX,
        "op3_line_dedup": LINES,
        "op4_token_counts": TOKEN_COUNTS,
        "op5_near_vectors": VECTORS,
        "op8_secret_scan": secret_scan(),
        "op10_ngram_join": NGRAMS,
        "op11_prefix_trie": TRIE,
        "op13_merkle_manifest": MERKLE,
    }
