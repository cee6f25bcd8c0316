"""SQL twins of the operators' queries, for DuckDB over the same tables."""

from corpusflow.llm.license import LEAST_COSINE, LICENCE_SHARE, TEMPLATES, TOKEN, UNNAMED, shapes

_LEAVES = r"""list_transform(string_split({0}, chr(10) || chr(10)), lambda s: list_transform(string_split(s, chr(10)),
    lambda p: list_transform(list_filter(regexp_extract_all(p, '[^.!?]{{0,40}}(?:[.!?]+|[^ \t]*[ \t]*)'), lambda x: x <> ''), lambda x: md5(x))))"""
_ROOT = """sha256(array_to_string(list_transform({0}, lambda s: sha256(array_to_string(list_transform(s,
    lambda p: sha256(array_to_string(p, ''))), ''))), ''))"""
_SHORT = "list_transform(flatten(flatten({0})), lambda x: substr(x, 1, 8))"
# distinct leaves in order of their first place
_FIRSTS = "list_filter({0}, lambda x, i: list_position({0}, x) = i)"
_NEAR = """CASE WHEN len({0}) + len({1}) = 0 THEN 1.0::DOUBLE
    ELSE len(list_intersect({0}, {1})) / len(list_distinct(list_concat({0}, {1})))::DOUBLE END"""

OP9 = f"""
WITH rows AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), placed AS (
  SELECT doc_id, text, coalesce(lead(text) OVER (ORDER BY doc_id, text), first_value(text) OVER (ORDER BY doc_id, text)) AS next_text
  FROM rows
), edits AS (
  SELECT *, left(text, length(text) - length(text) // 4) || left(next_text, length(text) // 4) AS edited FROM placed
), trees AS (
  SELECT doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256,
    {_LEAVES.format("text")} AS a, {_LEAVES.format("edited")} AS b, {_LEAVES.format("next_text")} AS c
  FROM edits
), leaves AS (
  SELECT *, {_SHORT.format("a")} AS sa, {_SHORT.format("b")} AS sb, {_SHORT.format("c")} AS sc FROM trees
)
SELECT doc_id, n_chars, edited_sha256,
  {_ROOT.format("a")} || ':' || array_to_string({_FIRSTS.format("sa")}, '') AS fingerprint,
  {_ROOT.format("b")} || ':' || array_to_string({_FIRSTS.format("sb")}, '') AS edited_fingerprint,
  {_NEAR.format("list_distinct(sa)", "list_distinct(sb)")} AS near_edited,
  {_NEAR.format("list_distinct(sa)", "list_distinct(sc)")} AS near_next
FROM leaves
"""

_TEMPLATES = ", ".join(f"({i}, '{name}', '{text.replace(chr(39), chr(39) * 2)}')" for i, (name, text) in enumerate(TEMPLATES))
_SHAPES = ", ".join(f"('{cue}', {before}, {length})" for cue, before, length in shapes())
_TOKENS = f"regexp_extract_all(lower({{0}}), '{TOKEN}')"

OP5 = f"""
WITH files AS (
  SELECT doc_id AS file, concat_ws('/', source, lang, doc_id || '.txt') AS path, {_TOKENS.format("text")} AS words FROM documents
), shapes AS (
  SELECT * FROM (VALUES {_SHAPES}) AS t(cue, before, length)
), placed_words AS (
  SELECT file, words, unnest(range(1, len(words) + 1)) AS i FROM files WHERE list_has_any(words, (SELECT list(cue) FROM shapes))
), passages AS (
  SELECT DISTINCT file, array_to_string(words[greatest(i - before, 1) : i - before + length - 1], ' ') AS key
  FROM placed_words JOIN shapes ON words[i] = cue
), distincts AS (
  SELECT key, count(*) AS copies FROM passages GROUP BY key
), counted AS (
  SELECT key, token, count(*) AS tf, any_value(copies) AS copies
  FROM (SELECT key, copies, unnest(string_split(key, ' ')) AS token FROM distincts) GROUP BY key, token
), forms AS (
  SELECT template, license, token, count(*) AS tf FROM (
    SELECT template, license, unnest({_TOKENS.format("text")}) AS token FROM (VALUES {_TEMPLATES}) AS t(template, license, text)
  ) GROUP BY ALL
), total AS (
  SELECT coalesce(sum(copies), 0) + {len(TEMPLATES)} AS total FROM distincts
), weights AS (
  SELECT token, ln((1.0 + total) / (1.0 + coalesce(df, 0) + listed)) + 1 AS idf
  FROM (SELECT token, count(*) AS listed FROM forms GROUP BY token) LEFT JOIN (SELECT token, sum(copies) AS df FROM counted GROUP BY token) USING (token), total
), vectors AS (
  SELECT license, template, token, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY template)) AS tw FROM forms JOIN weights USING (token)
), weighed AS (
  SELECT key, token, tf * coalesce(idf, ln(1.0 + total) + 1) AS w FROM counted LEFT JOIN weights USING (token), total
), norms AS (
  SELECT key, sqrt(sum(w * w)) AS norm FROM weighed GROUP BY key
), near AS (
  SELECT key, license, round(sum(w * tw) / any_value(norm), 6) AS cosine
  FROM weighed JOIN vectors USING (token) JOIN norms USING (key) GROUP BY key, template, license
), best AS (
  SELECT key, license, cosine, len(string_split(key, ' ')) AS n FROM near WHERE cosine >= {LEAST_COSINE}
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY cosine DESC, license) = 1
), own AS (
  SELECT file, license, cosine, n, max(n) OVER (PARTITION BY file) AS most FROM passages JOIN best USING (key)
  QUALIFY row_number() OVER (PARTITION BY file ORDER BY license = '{UNNAMED}', cosine DESC, n DESC, license) = 1
), placed AS (
  SELECT f.file, f.path, regexp_extract(f.path, '^(.*)/[^/]*$', 1) AS dir, o.license, o.cosine, o.n,
    o.most >= {LICENCE_SHARE} * len(f.words) AS licence_file
  FROM files f LEFT JOIN own o USING (file)
), licensed AS (
  SELECT dir, license FROM placed WHERE licence_file
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY license = '{UNNAMED}', cosine DESC, n DESC, license) = 1
), above AS (
  SELECT d.dir, l.license, l.dir AS licence_dir
  FROM (SELECT DISTINCT dir FROM placed) d JOIN licensed l ON l.dir = '' OR l.dir = d.dir OR starts_with(d.dir, l.dir || '/')
  QUALIFY row_number() OVER (PARTITION BY d.dir ORDER BY length(l.dir) DESC) = 1
)
SELECT p.file AS doc_id, p.path, coalesce(p.license, a.license) AS license, p.cosine,
  CASE WHEN p.license IS NOT NULL THEN 'header' WHEN a.license IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
  CASE WHEN p.license IS NULL THEN a.licence_dir END AS licence_dir
FROM placed p LEFT JOIN above a USING (dir)
"""

_ESCAPED = r"regexp_replace({0}, '<(\\*)\|', '<\\\1|', 'g')"

OP1 = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, n, role, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(n, role)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(24 + length(replace({_ESCAPED.format("role")}, chr(10), '<|nl|>')) + length({_ESCAPED.format("text")}))::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
"""

# in doubles, exact for whole numbers of this size
_APART = """CAST(list_inner_product(k.v::DOUBLE[], k.v::DOUBLE[]) - 2 * list_inner_product(k.v::DOUBLE[], c.v::DOUBLE[])
    + list_inner_product(c.v::DOUBLE[], c.v::DOUBLE[]) AS BIGINT)"""
_PLACED = f"""(SELECT k.id, k.vec_id, k.v, c.c, {_APART} AS d FROM kept k, {{0}} c
    QUALIFY row_number() OVER (PARTITION BY k.id ORDER BY {_APART}, c.c) = 1)"""
# exact floors of means, component by component
_MEANS = f"""(SELECT o.c, coalesce(n.v, o.v) AS v FROM {{0}} o LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY j) AS v FROM (
      SELECT c, j, sum(v[j])::BIGINT AS s, count(*) AS n FROM {_PLACED}, (SELECT unnest(range(1, 65)) AS j) GROUP BY c, j
    ) GROUP BY c) n USING (c))"""
_ROUNDS = ", ".join(f"c{i} AS MATERIALIZED {_MEANS.format(f'c{i - 1}')}" for i in range(1, 11))

OP12 = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS c, v FROM kept
  QUALIFY row_number() OVER (ORDER BY sha256('3:' || vec_id), v) <= 8
), {_ROUNDS}, placed AS MATERIALIZED {_PLACED.format("c10")}
SELECT p.vec_id, p.c::INTEGER AS cluster, p.d::BIGINT AS distance, (sum(p.d) OVER (PARTITION BY p.c))::BIGINT AS cluster_inertia,
  (sum(p.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c10.v, ',')) AS centroid_sha256
FROM placed p JOIN c10 USING (c)
"""

_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295)"""

OP13 = f"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_CRC.format("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS how FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN how = 1 THEN '' WHEN how = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN how = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM src WHERE how <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM damaged
), faults AS MATERIALIZED (
  SELECT conv_id, i, turn, role, text, left(role, 1) AS c, left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) AS before,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault
  FROM placed
), inserts AS (
  SELECT * FROM (VALUES ('', 0, '', ''), ('', 1, 'u', 'user:'), ('', 2, 'a', 'user:' || chr(10) || 'assistant:'),
    ('s', 0, 's', ''), ('s', 1, 'u', chr(10) || 'user:'), ('s', 2, 'a', chr(10) || 'user:' || chr(10) || 'assistant:'),
    ('u', 0, 'u', ''), ('u', 1, 'a', chr(10) || 'assistant:'), ('u', 2, 'u', chr(10) || 'assistant:' || chr(10) || 'user:'),
    ('a', 0, 'a', ''), ('a', 1, 'u', chr(10) || 'user:'), ('a', 2, 'a', chr(10) || 'user:' || chr(10) || 'assistant:')) AS t(q, n, q2, lines)
), edits AS (
  SELECT * FROM (VALUES ('D'), ('K'), ('R')) AS t(edit)
), best AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, '' AS q, struct_pack(cost := 0::BIGINT, audit := '', body := '') AS b FROM conversations
  UNION ALL
  SELECT conv_id, i, q, min(struct_pack(cost := cost, audit := audit, body := body)) AS b FROM (
    SELECT f.conv_id, f.i,
      CASE edit WHEN 'D' THEN n.q2 WHEN 'K' THEN f.c ELSE CASE n.q2 WHEN 'u' THEN 'a' ELSE 'u' END END AS q,
      b.b.cost + 5 * n.n + CASE edit WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END
        + CASE WHEN edit <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END AS cost,
      b.b.audit || repeat('I', n.n) || edit AS audit,
      b.b.body || n.lines || CASE WHEN edit = 'D' THEN '' ELSE CASE WHEN n.q2 = '' THEN '' ELSE chr(10) END
        || CASE WHEN edit = 'K' THEN role WHEN n.q2 = 'u' THEN 'assistant' ELSE 'user' END || ':' || text END AS body
    FROM best b JOIN inserts n ON n.q = b.q JOIN faults f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.i = b.i + 1, edits
    WHERE edit = 'D' OR (fault NOT IN ('blank', 'duplicate') AND (edit = 'R' OR (n.q2 = '' AND f.c = 's') OR f.c = CASE n.q2 WHEN 'u' THEN 'a' ELSE 'u' END))
  ) GROUP BY conv_id, i, q
), figures AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before || c NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id
), ended AS (
  SELECT b.conv_id, b.i, min(struct_pack(cost := b.b.cost + 5 * n.n, audit := b.b.audit || repeat('I', n.n), body := b.b.body || n.lines)) AS e
  FROM best b JOIN inserts n ON n.q = b.q WHERE n.q2 IN ('', 'a') GROUP BY b.conv_id, b.i
)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, e.e.cost AS cost, e.e.audit AS audit, sha256(e.e.body) AS repaired_sha256
FROM ended e LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM e.conv_id WHERE e.i = coalesce(f.n, 0)
"""

ORACLE = {"op1_chat": OP1, "op5_license": OP5, "op9_merkle": OP9, "op12_orchard": OP12, "op13_repair": OP13}
