"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_RULES = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
windows AS (
  SELECT r, i, w[i:i + 7] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)
),
repeated AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM repeated) GROUP BY r),
lines AS (SELECT r, l FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
dups AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM lines GROUP BY r),
m AS (
  SELECT d.r, doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(dups.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM d LEFT JOIN covered USING (r) LEFT JOIN dups USING (r)
),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
hosts AS (SELECT source, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (base_failed) AS DOUBLE) AS k FROM f GROUP BY source),
pool AS (SELECT sum(k) / sum(n) AS p, sum(n * (k / n) * (k / n)) / sum(n) AS sq, count(*) / sum(n) AS share FROM hosts),
prior AS (
  SELECT p, CASE WHEN sq - p * p > p * (1 - p) * share
    THEN greatest(1.0, p * (1 - p) / (sq - p * p - p * (1 - p) * share) - 1) END AS s FROM pool
),
bad AS (SELECT source FROM hosts, prior WHERE CASE WHEN s IS NULL THEN p ELSE (k + p * s) / (n + s) END
  > least(0.5, greatest(0.3, p + CASE WHEN s IS NULL THEN 0 ELSE 2 * sqrt(p * (1 - p) / (s + 1)) END)))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT EXISTS (SELECT 1 FROM bad WHERE bad.source IS NOT DISTINCT FROM f.source) AS kept
FROM f
"""

_NEAR = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) < 2 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
    FROM words)
),
sizes AS (SELECT doc_id, count(s) AS n FROM words LEFT JOIN shingles USING (doc_id) GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
links AS (
  SELECT x, y FROM common JOIN sizes sx ON sx.doc_id = x JOIN sizes sy ON sy.doc_id = y WHERE 100 * k >= 80 * (sx.n + sy.n - k)
),
reach AS (SELECT doc_id AS x, doc_id AS y FROM words UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT s.doc_id, s.n AS n_shingles, min(r.y) AS component_id, s.doc_id = min(r.y) AS kept
FROM sizes s JOIN reach r ON r.x = s.doc_id GROUP BY s.doc_id, s.n
"""

_TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 64) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0
),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

_JOIN = (
    _NEAR.replace("len(w) < 2 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])",
                  "len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] "
                  "ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])")
    .replace("100 * k >= 80 *", "100 * k >= 90 *")
    .replace(", s.doc_id = min(r.y) AS kept", "")
)


def _clusters(rounds: int = 3) -> str:
    """Assignments and means of each round, one pair of named queries after the other."""
    parts = ["""
v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 64) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
c0 AS (
  SELECT k, v FROM (SELECT v, row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS k FROM v WHERE vec_id IS NOT NULL) WHERE k < 16
)"""]
    for n in range(rounds + 1):
        parts.append(f"""
a{n} AS (
  SELECT r, k, d FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY d, k) AS place FROM (
    SELECT v.r, c.k, CAST(list_sum(list_transform(range(1, 65), lambda i: (v.v[i] - c.v[i]) * (v.v[i] - c.v[i]))) AS BIGINT) AS d
    FROM v, c{n} AS c)) WHERE place = 1
)""")
        if n < rounds:
            parts.append(f"""
s{n} AS (
  SELECT k, i, sum(x) AS s, count(*) AS n FROM (
    SELECT k, unnest(v.v) AS x, unnest(range(1, 65)) AS i FROM a{n} JOIN v USING (r)) GROUP BY k, i
),
c{n + 1} AS (
  SELECT c.k, coalesce(m.v, c.v) AS v FROM c{n} AS c LEFT JOIN (
    SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM s{n} GROUP BY k) AS m USING (k)
)""")
    return f"""WITH {",".join(parts)}
SELECT vec_id, CAST(a.k AS INTEGER) AS cluster, d AS distance,
       CAST(sum(d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} AS a JOIN v USING (r) JOIN c{rounds} AS c ON c.k = a.k
"""


def _repair() -> str:
    """Costs, audits and texts carried from the last row to the first, for the states start, s, u, a."""
    wanted = (("user", 3), ("user", 3), ("assistant", 4), ("user", 3))
    keeps = ({"s": 2, "u": 3}, {"u": 3}, {"a": 4}, {"u": 3})
    step, closed = [], []
    for q, ((role, to), keep) in enumerate(zip(wanted, keeps), 1):
        options = [f"{{'c': v[{q}].c + 3, 'a': 'D' || v[{q}].a, 'b': v[{q}].b}}"]
        options += [
            f"CASE WHEN sym = '{i}' THEN {{'c': v[{t}].c + extra, 'a': 'K' || v[{t}].a, 'b': list_prepend(role || ':' || text, v[{t}].b)}} END"
            for i, t in keep.items()
        ]
        options.append(
            f"CASE WHEN sym <> 'x' THEN {{'c': v[{to}].c + extra + 2, 'a': 'R' || v[{to}].a, 'b': list_prepend('{role}:' || text, v[{to}].b)}} END"
        )
        step.append(f"list_min(list_filter([{', '.join(options)}], lambda o: o IS NOT NULL))")
        chain, here, lines = [f"w[{q}]"], q, []
        for n in range(1, 4):
            name, after = wanted[here - 1]
            lines, here = [*lines, f"'{name}:'"], after
            chain.append(f"{{'c': w[{here}].c + {2 * n}, 'a': '{'I' * n}' || w[{here}].a, 'b': list_concat([{', '.join(lines)}], w[{here}].b)}}")
        closed.append(f"list_min([{', '.join(chain)}])")
    none = "CAST([] AS VARCHAR[])"
    return rf"""
WITH RECURSIVE tab AS (
  SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(
    list_prepend(CAST(i AS UBIGINT), list_transform(range(8), lambda x: CAST(0 AS UBIGINT))),
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(CAST(3988292384 AS UBIGINT), c >> 1) ELSE c >> 1 END) AS c FROM range(256) AS g(i))
),
keyed AS (
  SELECT dense_rank() OVER (ORDER BY conv_id) AS g, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations
),
kinds AS (
  SELECT *, xor(CAST(4294967295 AS UBIGINT), list_reduce(
    list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split(key, ''), lambda ch: CAST(ascii(ch) AS UBIGINT))),
    lambda c, b: xor(c >> 8, t[CAST(xor(c & 255, b) + 1 AS BIGINT)]))) % 20 AS kind FROM keyed, tab
),
after AS (
  SELECT g, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM kinds
),
placed AS (
  SELECT *, left(role, 1) AS initial,
         row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text), copy) AS p FROM after
),
faulty AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
    WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY p) > 1 THEN 2
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 3 ELSE 0 END AS fault,
    lag(initial) OVER (PARTITION BY g ORDER BY p) AS before FROM placed
),
turns AS (
  SELECT g, p, role, text, CASE WHEN fault IN (1, 2) THEN 'x' WHEN initial IN ('s', 'u', 'a') THEN initial ELSE 'o' END AS sym,
         CASE WHEN fault = 3 THEN 1 ELSE 0 END AS extra FROM faulty
),
facts AS (
  SELECT g, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps, count(*) FILTER (fault = 1) AS blank,
         count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(p) AS n
  FROM faulty GROUP BY g
),
back AS (
  SELECT g, n + 1 AS p, [{{'c': 0, 'a': '', 'b': {none}}}, {{'c': 4, 'a': 'II', 'b': ['user:', 'assistant:']}},
    {{'c': 2, 'a': 'I', 'b': ['assistant:']}}, {{'c': 0, 'a': '', 'b': {none}}}] AS v FROM facts
  UNION ALL
  SELECT g, p, [{", ".join(closed)}] FROM (
    SELECT b.g, t.p, [{", ".join(step)}] AS w FROM back AS b JOIN turns AS t ON t.g = b.g AND t.p = b.p - 1)
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(v[1].c, 0) AS BIGINT) AS cost,
       coalesce(v[1].a, '') AS audit, sha256(coalesce(array_to_string(v[1].b, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT g, conv_id FROM keyed) AS c LEFT JOIN facts USING (g) LEFT JOIN back ON back.g = c.g AND back.p = 1
"""


ORACLE = {
    "op5_host_rules": _RULES, "op6_near_duplicates": _NEAR, "op8_top_k": _TOP_K,
    "op11_set_join": _JOIN, "op12_centroids": _clusters(), "op13_turn_repair": _repair(),
}
