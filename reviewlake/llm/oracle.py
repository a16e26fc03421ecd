"""DuckDB SQL for the training-data queries that SQL can express."""

ORACLE: dict[str, str] = {}

# Targets in closed form: the level is set by the sources that stay below their stop,
# which are a suffix in the order of stop / weight.  The taken documents are a prefix in
# hash order, found by sorting (the operator itself never sorts).
ORACLE["op5_mixing"] = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce('v' || doc_id::VARCHAR, 'n') || ':v' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight
  FROM docs GROUP BY source),
lvl AS (
  SELECT *, 2.0 * source_size / weight AS stop,
         coalesce(sum(2.0 * source_size) OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
         sum(weight) OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free,
         (sum(source_size) OVER ()) * 1.5 AS total
  FROM src),
level AS (SELECT arg_min((total - used) / free, stop) AS level FROM lvl WHERE (total - used) / free <= stop),
tgt AS (
  SELECT source, source_size, least(2.0 * source_size, weight * level)::DOUBLE AS target FROM src, level),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM tgt),
grp AS (SELECT source, h, sum(size) AS g FROM docs GROUP BY source, h),
run AS (SELECT *, sum(g) OVER (PARTITION BY source ORDER BY h) AS upto FROM grp),
cut AS (
  SELECT r.source, r.h, r.upto <= b.budget OR (r.upto - r.g <= b.budget AND r.g <= 2 * (b.budget - (r.upto - r.g))) AS more
  FROM run r JOIN (SELECT source, target - whole * source_size AS budget FROM plan) b ON r.source IS NOT DISTINCT FROM b.source)
SELECT d.doc_id, d.size, p.source_size, p.target, (d.size * (p.whole + CASE WHEN c.more THEN 1 ELSE 0 END))::BIGINT AS taken
FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
JOIN cut c ON d.source IS NOT DISTINCT FROM c.source AND d.h = c.h
"""

_SENTENCE = r"""
  SELECT doc_id, list_filter(list_transform(string_split(
    regexp_replace(regexp_replace(coalesce(text, ''), '([.!?;:])[ \t\r\n]+', '\1' || chr(1), 'g'), '[ \t\r]*\n+([^a-z]|\z)', chr(1) || '\1', 'g'), chr(1)),
    lambda s: trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))), lambda s: s <> '') AS parts
  FROM documents"""


def _license_sql() -> str:
    from reviewlake.llm.licenses import KNOWN, RULES, pattern

    known = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in KNOWN.items()) + "}"
    steps, last = [], "signs0"
    for i, (_, rule) in enumerate(RULES):
        rest = "s" if i == 0 else "rest"
        steps.append(
            f"r{i} AS (SELECT * EXCLUDE (rest), regexp_matches(rest, '{pattern(rule)}') AS m{i}, "
            f"regexp_replace(rest, '{pattern(rule)}', '.', 'g') AS rest FROM {last})"
        )
        last = f"r{i}"
    names = ", ".join(f"CASE WHEN m{i} THEN '{n}' END" for i, (n, _) in enumerate(RULES))
    order = ", ".join(f"'{n}'" for n in dict.fromkeys(n for n, _ in RULES))
    return f"""
WITH sentences AS ({_SENTENCE}),
signs0 AS (SELECT doc_id, s, s AS rest FROM (
  SELECT doc_id, coalesce(array_to_string(list_transform(parts, lambda p: coalesce(map_extract({known}, p)[1], '.')), ''), '') AS s FROM sentences)),
{", ".join(steps)}
SELECT doc_id, length(s)::BIGINT AS n_sentences, length(replace(s, '.', ''))::BIGINT AS n_known,
       regexp_replace(regexp_replace(s, '^\\.+|\\.+\\z', '', 'g'), '\\.{{3,}}', '...', 'g') AS signs,
       coalesce(array_to_string(list_filter([{order}], lambda n: list_contains([{names}], n)), ','), '') AS licences
FROM {last}""".replace("\\\\", "\\")


ORACLE["op3_licenses"] = _license_sql()

# Digests straight from the rows, not from formatted text; a turn's fixed marks take 24 code points.
ORACLE["op6_chat"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(24 + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\\\1|', 'g'))
              + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""

# Candidates are all rows: SQL scores every pair.
ORACLE["op2_threshold_topk"] = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q::DOUBLE[], b.q::DOUBLE[])::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q))
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s) WHERE rank <= 20
"""

# Every phrase is counted, frequent or not.
ORACLE["op11_collocations"] = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
total AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k),
f AS (SELECT lang, k, phrase, count(*)::BIGINT AS a FROM grams GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
cut AS (
  SELECT lang, phrase, a, i, array_to_string(ws[1:i], ' ') AS lp, array_to_string(ws[i + 1:], ' ') AS rp
  FROM (SELECT *, unnest(range(1, k)) AS i FROM c)),
cuts AS (
  SELECT t.lang, t.phrase, t.a, t.i, l.a AS l, r.a AS r, (2000000::HUGEINT * t.a) // (l.a + r.a) AS score
  FROM cut t JOIN f l ON l.lang = t.lang AND l.phrase = t.lp JOIN f r ON r.lang = t.lang AND r.phrase = t.rp),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
inside AS (
  SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c WHERE k > 2)) GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * b.a)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN total USING (lang)
WHERE rank <= 2000
"""

# Shared shingles are counted per pair of documents; components are the closure of the links.
ORACLE["op12_jaccard_join"] = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT r, doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))) END AS g FROM d),
g AS (SELECT r, len(g) AS n, unnest(g) AS gram FROM s),
links AS (
  SELECT a.r AS x, b.r AS y FROM g a JOIN g b USING (gram) WHERE a.r <> b.r
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach(x, y) AS (SELECT r, r FROM s UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
least AS (SELECT reach.x AS r, min(s.doc_id) AS component_id FROM reach JOIN s ON s.r = reach.y GROUP BY reach.x)
SELECT doc_id, len(g)::BIGINT AS n_shingles, component_id FROM s JOIN least USING (r)
"""


def _centroid_sql(k: int = 40, rounds: int = 5, dims: int = 64) -> str:
    near = f"""
  SELECT vec_id, q, arg_min(j, dist * {k} + j) AS cluster, min(dist) AS distance FROM (
    SELECT v.r, v.vec_id, v.q, c.j, list_sum(list_transform(list_zip(v.q, c.q), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::HUGEINT AS dist FROM v, c{{i}} c)
  GROUP BY r, vec_id, q"""
    steps = [
        f"""a{i} AS MATERIALIZED ({near.format(i=i)}),
m{i} AS (SELECT cluster, pos, sum(x) AS total, count(*) AS n FROM (SELECT cluster, unnest(q) AS x, generate_subscripts(q, 1) AS pos FROM a{i}) GROUP BY cluster, pos),
n{i} AS (SELECT cluster, list((total - ((total % n) + n) % n) // n ORDER BY pos)::BIGINT[] AS q FROM m{i} GROUP BY cluster),
c{i + 1} AS MATERIALIZED (SELECT c.j, coalesce(n.q, c.q) AS q FROM c{i} c LEFT JOIN n{i} n ON n.cluster = c.j)"""
        for i in range(rounds)
    ]
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, q) - 1 AS j, q FROM (
    SELECT sha256('2:' || vec_id) AS h, q FROM v WHERE vec_id IS NOT NULL ORDER BY h, q LIMIT {k})),
{", ".join(steps)},
z AS MATERIALIZED ({near.format(i=rounds)})
SELECT vec_id, cluster::INTEGER AS cluster, distance::BIGINT AS distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM z JOIN c{rounds} c ON c.j = z.cluster"""


ORACLE["op13_centroids"] = _centroid_sql()
