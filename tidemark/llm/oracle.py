"""SQL twins of the queries, where SQL can express them.

op3 (packing), op4 and op8 (tokenizers), op6 (edits of token counts), op9 (checksums)
and op10 (training) cannot be said in SQL; tests/llm hold them against brute force,
round trips or held-out labels.
"""

from __future__ import annotations

from tidemark.llm.quality import (
    CLASS_NOISE,
    COMMON_SHARE,
    MAX_CLASS_DISTANCE,
    MAX_REPEATED_PCT,
    MAX_WORD_DISTANCE,
    MIN_WORDS,
    NOISE_WEIGHT,
)

_SPACE = r"[\x20\x09-\x0D]+"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex(coalesce({text}, ''), '{_SPACE}'), lambda x: x <> '')"


def _kept(pattern: str) -> str:
    """How many characters of the text are in a bracket expression."""
    return f"length(regexp_replace(text, '[^{pattern}]', '', 'g'))"


def _reach(nodes: str, links: str) -> str:
    """CTEs ``both`` and ``reach``: everything that links lead to from each node."""
    return f"""
both_ways AS (SELECT a, b FROM {links} UNION ALL SELECT b, a FROM {links}),
reach(id, r) AS (
  SELECT id, id FROM {nodes}
  UNION
  SELECT reach.id, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.r
),
component AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id)"""


_OP1 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         CASE WHEN regexp_full_match(regexp_extract(lower(lang), '^[^-_]*'), '[a-z]{{2,3}}')
              THEN regexp_extract(lower(lang), '^[^-_]*') ELSE 'und' END AS lang,
         {_words('text')} AS w, {_words(_LOWER.format('text'))} AS lw
  FROM documents
),
class AS (
  SELECT doc_id, lang, unnest([
    {_kept('a-z')}, {_kept('A-Z')}, {_kept('0-9')}, {_kept('\\x20\\x09-\\x0D')},
    {_kept('.,;:\'\'"!?()-')}, {_kept('#*$%&|<>')}, 0,
    length(regexp_replace(text, '[\x00-\x7f]', '', 'g'))]) AS n,
    unnest(range(8)) AS item, length(text) AS chars
  FROM d
),
class_n AS (  -- the seventh class is what is left
  SELECT doc_id, lang, item, chars,
         CASE item WHEN 6 THEN chars - sum(n) OVER (PARTITION BY doc_id) ELSE n END AS n
  FROM class
),
class_ref AS (
  SELECT lang, item, sum(n) / greatest(sum(sum(n)) OVER (PARTITION BY lang), 1) AS q
  FROM class_n GROUP BY lang, item
),
class_far AS (
  SELECT doc_id, sqrt(greatest(sum(
           CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
         + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)) AS far
  FROM (SELECT doc_id, q, n / greatest(chars, 1) AS p FROM class_n JOIN class_ref USING (lang, item))
  GROUP BY doc_id
),
word AS (SELECT doc_id, lang, unnest(lw) AS item FROM d),
word_total AS (SELECT lang, count(*) AS total FROM word GROUP BY lang),
word_ref AS (
  SELECT lang, item, count(*) / total AS q
  FROM word JOIN word_total USING (lang) GROUP BY lang, item, total
  HAVING count(*) >= {COMMON_SHARE} * total
),
with_rest AS (
  SELECT lang, item, q FROM word_ref
  UNION ALL
  SELECT t.lang, NULL, 1 - coalesce((SELECT sum(q) FROM word_ref r WHERE r.lang = t.lang), 0)
  FROM word_total t
),
word_n AS (
  SELECT word.doc_id, word.lang, word_ref.item AS item, count(*) AS n
  FROM word LEFT JOIN word_ref USING (lang, item) GROUP BY ALL
),
word_far AS (
  SELECT doc_id, sqrt(greatest(sum(
           CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
         + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)) AS far
  FROM (
    SELECT d.doc_id, r.q, coalesce(n.n, 0) / greatest(len(d.lw), 1) AS p
    FROM d JOIN with_rest r USING (lang)
    LEFT JOIN word_n n ON n.doc_id = d.doc_id AND n.item IS NOT DISTINCT FROM r.item
  ) GROUP BY doc_id
),
line AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM d),
dup AS (
  SELECT doc_id, count(*) - count(DISTINCT x) AS n FROM line
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
win AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS times FROM (
    SELECT doc_id, unnest(range(1, len(w) - 1)) AS i,
           unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS x
    FROM d WHERE len(w) >= 3)
),
rep AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM win, (SELECT unnest([0, 1, 2]) AS k)
  WHERE times > 1 GROUP BY doc_id
),
joined AS (
  SELECT d.doc_id, len(w) AS n_words,
         CAST(length(regexp_replace(text, '{_SPACE}', '', 'g')) AS BIGINT) AS word_chars,
         CAST({_kept('#*$%&|<>')} AS BIGINT) AS n_symbols,
         coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
         coalesce(class_far.far, 0) AS cf, coalesce(word_far.far, 0) AS wf,
         7 / (8 * ln(2) * greatest(length(text), 1)) AS c_noise,
         (SELECT count(*) FROM word_ref WHERE word_ref.lang = d.lang)
           / (8 * ln(2) * greatest(len(w), 1)) AS w_noise
  FROM d LEFT JOIN class_far USING (doc_id) LEFT JOIN word_far USING (doc_id)
  LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id)
),
judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PCT} * n_words AS base_failed
  FROM joined
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed
       AND NOT (c_noise <= {CLASS_NOISE * MAX_CLASS_DISTANCE**2} AND cf > {MAX_CLASS_DISTANCE})
       AND NOT (w_noise <= {MAX_WORD_DISTANCE**2}
                AND wf > sqrt({MAX_WORD_DISTANCE**2} + {NOISE_WEIGHT} * w_noise)) AS kept,
       round(cf, 6) AS class_distance, round(wf, 6) AS word_distance
FROM judged
"""

_OP2 = f"""
WITH RECURSIVE v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS x FROM embeddings),
usable AS (
  SELECT id, x, sqrt(list_dot_product(x, x)) AS size FROM v
  WHERE len(x) > 0 AND len(list_filter(x, lambda y: y IS NULL OR NOT isfinite(y))) = 0
    AND len(list_filter(x, lambda y: y <> 0)) > 0
),
links AS (
  SELECT p.id AS a, q.id AS b FROM usable p JOIN usable q ON p.id < q.id AND len(p.x) = len(q.x)
  WHERE list_dot_product(p.x, q.x) / (p.size * q.size) >= 0.9
),
{_reach('v', 'links')},
degree AS (SELECT a AS id, count(*) AS n FROM both_ways GROUP BY a)
SELECT c.id AS vec_id, coalesce(degree.n, 0) AS n_links, component_id, c.id = component_id AS kept
FROM component c LEFT JOIN degree USING (id)
"""

_OP5 = f"""
WITH RECURSIVE d AS (SELECT doc_id AS id, {_words(_LOWER.format('text'))} AS w FROM documents),
s AS (
  SELECT id, CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
  END AS x FROM d
),
one AS (SELECT id, len(x) AS n, unnest(x) AS x FROM s),
links AS (
  SELECT p.id AS a, q.id AS b FROM one p JOIN one q ON p.x = q.x AND p.id < q.id
  GROUP BY p.id, q.id, p.n, q.n HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))
),
{_reach('s', 'links')}
SELECT s.id AS doc_id, len(s.x) AS n_shingles, component_id, s.id = component_id AS kept
FROM s JOIN component USING (id)
"""

_OP7 = r"""
WITH line AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS x,
         generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents
),
trimmed AS (
  SELECT doc_id, i, trim(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS t FROM line
),
win AS (
  SELECT doc_id, i AS low, lead(i, 2) OVER o AS high, t, lead(t) OVER o AS t2, lead(t, 2) OVER o AS t3
  FROM trimmed WHERE t <> '' WINDOW o AS (PARTITION BY doc_id ORDER BY i)
),
later AS (
  SELECT doc_id, low, high FROM win WHERE high IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY t, t2, t3 ORDER BY doc_id, low) > 1
),
gone AS (
  SELECT DISTINCT line.doc_id, line.i FROM line
  JOIN later ON later.doc_id = line.doc_id AND line.i BETWEEN later.low AND later.high
),
result AS (
  SELECT line.doc_id, count(gone.i) AS n_lines_removed,
         coalesce(string_agg(line.x, chr(10) ORDER BY line.i) FILTER (WHERE gone.i IS NULL), '') AS text
  FROM line LEFT JOIN gone USING (doc_id, i) GROUP BY line.doc_id
)
SELECT doc_id, coalesce(n_lines_removed, 0) AS n_lines_removed,
       CASE WHEN d.text IS NOT NULL THEN length(coalesce(result.text, '')) END AS n_chars_left,
       CASE WHEN d.text IS NOT NULL THEN md5(coalesce(result.text, '')) END AS text_md5
FROM documents d LEFT JOIN result USING (doc_id)
"""

_OP11 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (
  SELECT page_id, payload, strlen(payload) AS payload_bytes,
         CAST(CAST(unhex(sha1(payload)) AS BIT) AS VARCHAR) AS bits,
         min(page_id) OVER (PARTITION BY payload) AS first
  FROM p
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + list_sum(list_transform(range(5), lambda j:
           CAST(substr(bits, 5 * k + j + 1, 1) AS INT) * (16 >> j)))::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM d
"""


def _rounds(rounds: int) -> str:
    """CTEs near0, centroid1, near1 ...: each round's nearest centroids and their means."""
    near = """
near{k} AS MATERIALIZED (
  SELECT vec_id, c AS cluster, far AS distance FROM (
    SELECT vec_id, c, sum((part.x - centroid{k}.x) * (part.x - centroid{k}.x))::BIGINT AS far
    FROM part JOIN centroid{k} USING (i) GROUP BY vec_id, c
  ) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY far, c) = 1
)"""
    mean = """,
mean{k} AS (
  SELECT cluster AS c, i, sum(x) AS total, count(*) AS n
  FROM near{k} JOIN part USING (vec_id) GROUP BY cluster, i
),
centroid{next} AS MATERIALIZED (
  SELECT c, i, CASE WHEN n IS NULL THEN x
    ELSE (total - ((total % n) + n) % n) // n END::BIGINT AS x  -- floored
  FROM centroid{k} LEFT JOIN mean{k} USING (c, i)
),"""
    out = "".join(near.format(k=k) + mean.format(k=k, next=k + 1) for k in range(rounds))
    return out + near.format(k=rounds)


_OP12 = f"""
WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
),
part AS MATERIALIZED (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM kept),
chosen AS (
  SELECT v, row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS c FROM kept
  QUALIFY c < 40
),
centroid0 AS MATERIALIZED (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM chosen),
{_rounds(5)},
mark AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM centroid5 GROUP BY c)
SELECT vec_id, cluster::INT AS cluster, distance,
       sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia, centroid_sha256
FROM near5 JOIN mark ON mark.c = near5.cluster
"""

_OP13 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, {_words('text')} AS w FROM documents
),
failing AS (
  SELECT d.doc_id, part, coalesce(quality = 1, FALSE) AS good, coalesce(toxic = 1, FALSE) AS toxic,
         CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * {_kept('A-Z')} > 10 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails
  FROM d LEFT JOIN labels ON labels.doc_id = d.doc_id
),
like_ AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM failing GROUP BY part, fails
),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order
  FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
),
seen AS (
  SELECT *, contains(fails, own) AS here, translate(fails, before, '') <> fails AS earlier
  FROM like_, steps
),
counted AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (WHERE NOT here AND NOT earlier), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (WHERE here AND NOT earlier), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (WHERE here AND earlier), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (WHERE fails = own), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (WHERE here AND NOT earlier), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE here AND NOT earlier), 0)::BIGINT AS toxic_lost
  FROM seen GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley
FROM counted
"""

SQL = {
    "op1_distribution_divergence": _OP1,
    "op2_spherical_caps": _OP2,
    "op5_setsketch": _OP5,
    "op7_line_windows": _OP7,
    "op11_zstd_archives": _OP11,
    "op12_incremental_distances": _OP12,
    "op13_filter_audit": _OP13,
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
