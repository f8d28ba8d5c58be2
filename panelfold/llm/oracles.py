"""The SQL that queries of the numbered operators must equal, where SQL can express them.

Each is written from the query's definition over whole tables: a plain count of every window or pair.
"""

from __future__ import annotations

from panelfold.llm import decontaminate as d

REPEATS = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT doc_id, s, array_slice(b, s, s + 199) AS k FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - 198)) AS s FROM d)),
r AS (SELECT doc_id, s FROM (SELECT doc_id, s, count(*) OVER (PARTITION BY k) AS c FROM w) WHERE c > 1),
i AS (SELECT doc_id, s, sum(far) OVER (PARTITION BY doc_id ORDER BY s) AS g
      FROM (SELECT doc_id, s, CASE WHEN s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 200 THEN 1 ELSE 0 END AS far FROM r)),
p AS (SELECT doc_id, list(a ORDER BY a) AS la, list(z ORDER BY a) AS lz, CAST(sum(z - a + 1) AS BIGINT) AS gone, count(*) AS n
      FROM (SELECT doc_id, g, min(s) AS a, max(s) + 199 AS z FROM i GROUP BY doc_id, g) GROUP BY doc_id),
c AS (SELECT d.doc_id, b, octet_length(b) AS size, gone, n, list_prepend(1, list_transform(lz, lambda z: z + 1)) AS first,
        list_append(list_transform(la, lambda a: a - 1), octet_length(b)) AS last FROM d LEFT JOIN p ON p.doc_id = d.doc_id)
SELECT doc_id, size AS n_bytes, coalesce(gone, 0) AS n_removed, coalesce(n, 0) AS n_spans,
  sha256(CASE WHEN n IS NULL THEN b ELSE list_reduce(list_transform(range(1, n + 2),
    lambda k: CASE WHEN first[k] > last[k] THEN ''::BLOB ELSE array_slice(b, first[k], last[k]) END), lambda x, y: x || y) END) AS kept_sha256
FROM c
"""

EMBEDDINGS = """
WITH RECURSIVE e AS (SELECT a.vec_id AS x, b.vec_id AS y FROM embeddings a, embeddings b
  WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) >= 0.95),
reach AS (SELECT vec_id AS v, vec_id AS c FROM embeddings UNION SELECT y, c FROM reach JOIN e ON x = v),
least AS (SELECT v, min(c) AS c FROM reach GROUP BY v), links AS (SELECT x, count(*) AS n FROM e GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, c AS component_id, vec_id = c AS kept FROM embeddings JOIN least ON v = vec_id LEFT JOIN links ON x = vec_id
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _replaced(expression: str, rules) -> str:
    for pattern, replacement in rules:
        expression = f"regexp_replace({expression}, {_quoted(pattern)}, {_quoted(replacement.replace('$', chr(92)))}, 'g')"
    return expression


def _words(text: str) -> str:
    return f"list_filter(string_split({text}, ' '), lambda x: x <> '')"


_MARK = _quoted(f"^[{d.NUMBER}-{d.NAME}]")
_CANONICAL = f"trim(lower({_replaced('coalesce(text, \'\')', d.RULES)}))"
_LAST = d.WINDOW - 1

LEAKS = f"""
WITH dc AS (SELECT doc_id, {_CANONICAL} AS c FROM documents), ic AS (SELECT item_id, {_CANONICAL} AS c FROM benchmark),
dw AS (SELECT doc_id, {_words('c')} AS v, {_words(_replaced('c', [d.SLOT_RULE]))} AS w FROM dc),
iw AS (SELECT item_id, {_words('c')} AS v, {_words(_replaced('c', [d.SLOT_RULE]))} AS w FROM ic),
dk AS (SELECT doc_id, i - 1 AS pos, array_to_string(w[i : i + {_LAST}], ' ') AS k
       FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - {_LAST}) + 1)) AS i FROM dw)),
ik AS (SELECT item_id, i - 1 AS item_at, array_to_string(w[i : i + {_LAST}], ' ') AS k
       FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - {_LAST}) + 1)) AS i FROM iw)
       WHERE len(list_filter(w[i : i + {_LAST}], lambda x: NOT regexp_matches(x, {_MARK}))) > 0),
hits AS (SELECT doc_id, item_id, pos, item_at FROM dk JOIN ik USING (k)),
size AS (SELECT item_id, count(DISTINCT item_at) AS n_windows FROM ik GROUP BY item_id),
shifts AS (SELECT doc_id, item_id, pos - item_at AS shift, list(DISTINCT item_at) AS places,
             row_number() OVER (PARTITION BY doc_id, item_id ORDER BY count(*) DESC, pos - item_at) AS place FROM hits GROUP BY doc_id, item_id, pos - item_at),
best AS (SELECT doc_id, item_id, shift, places FROM shifts WHERE place = 1),
found AS (SELECT doc_id, item_id, n_windows, count(DISTINCT item_at) AS n_matched FROM hits JOIN best USING (doc_id, item_id) JOIN size USING (item_id)
          WHERE abs(pos - item_at - shift) <= {d.NEAR} GROUP BY ALL HAVING n_matched >= {d.LEAST_COVERAGE} * n_windows OR n_matched >= {d.LEAST_RUN}),
asked AS (SELECT doc_id, item_id, shift, v[i] AS value, i - 1 AS slot, places
          FROM (SELECT *, unnest(range(1, len(v) + 1)) AS i FROM found JOIN best USING (doc_id, item_id) JOIN iw USING (item_id))
          WHERE regexp_matches(v[i], {_MARK}) AND len(list_filter(places, lambda p: p <= i - 1 AND i - 1 < p + {d.WINDOW})) > 0),
filled AS (SELECT doc_id, item_id, value, v[slot + shift + 1] AS filling, count(*) AS n FROM asked JOIN dw USING (doc_id) GROUP BY ALL),
agreed AS (SELECT doc_id, item_id, CAST(sum(n) AS BIGINT) AS n_slots, CAST(sum(most) AS BIGINT) AS n_consistent
           FROM (SELECT doc_id, item_id, value, sum(n) AS n, max(n) AS most FROM filled GROUP BY ALL) GROUP BY ALL)
SELECT doc_id, item_id, n_windows, n_matched, coalesce(n_slots, 0) AS n_slots, coalesce(n_consistent, 0) AS n_consistent
FROM found LEFT JOIN agreed USING (doc_id, item_id) WHERE coalesce(n_consistent, 0) >= {d.LEAST_CONSISTENT} * coalesce(n_slots, 0)
"""



def _clusters(rounds: int = 10, clusters: int = 8) -> str:
    """Lloyd's rounds, one after another, each distance computed."""
    distance = "list_sum(list_transform(list_zip(k.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    parts = [
        """k AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda v: CAST(floor(1024 * CAST(v AS DOUBLE)) AS BIGINT)) AS x
          FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(CAST(v AS DOUBLE)))) = 64)""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x
          FROM (SELECT sha256('3:' || vec_id) AS h, x FROM k ORDER BY h NULLS LAST, x LIMIT {clusters}))""",
    ]
    for t in range(rounds + 1):
        parts.append(f"""a{t} AS MATERIALIZED (SELECT r, CAST(m % {clusters} AS INTEGER) AS c, CAST(m // {clusters} AS BIGINT) AS d
          FROM (SELECT r, min(CAST({distance} AS HUGEINT) * {clusters} + c.c) AS m FROM k CROSS JOIN c{t} c GROUP BY r))""")
        if t < rounds:
            parts.append(f"""c{t + 1} AS MATERIALIZED (SELECT p.c, coalesce(n.x, p.x) AS x FROM c{t} p LEFT JOIN (
              SELECT c, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY i) AS x
              FROM (SELECT c, i, sum(v) AS s, count(*) AS n FROM (SELECT a.c, unnest(k.x) AS v, unnest(range(64)) AS i FROM k JOIN a{t} a ON a.r = k.r) GROUP BY c, i)
              GROUP BY c) n ON n.c = p.c)""")
    return f"""WITH {", ".join(parts)}
      SELECT vec_id, a.c AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
        CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
      FROM k JOIN a{rounds} a ON a.r = k.r JOIN c{rounds} c ON c.c = a.c"""


CLUSTERS = _clusters()


def _conversations() -> str:
    """Damage, faults, costs from the last row to the first, and the edits replayed."""
    given = {"z": "u", "s": "u", "u": "a", "a": "u"}
    keeps = {"z": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    def way(state: str, cost: str, edit: str) -> str:
        return f"{{'c': d.{state}.c + {cost}, 'a': '{edit}' || d.{state}.a}}"

    def least(options: list[str]) -> str:
        return f"list_sort(list_filter([{', '.join(options)}], lambda w: w IS NOT NULL))[1]"

    def edited(state: str) -> str:
        kept = [f"CASE WHEN r.initial = '{i}' AND NOT r.gone THEN {way(to, 'r.more', 'K')} END" for i, to in keeps[state].items()]
        return least([way(state, "4", "D"), f"CASE WHEN NOT r.gone THEN {way(given[state], '3 + r.more', 'R')} END", *kept])

    def inserted(state: str) -> str:
        one, two = given[state], given[given[state]]
        more = [f"{{'c': e_{s}.c + {3 * n}, 'a': '{'I' * n}' || e_{s}.a}}" for n, s in ((1, one), (2, two))]
        return least([f"e_{state}", *more])

    tail = {"z": (0, ""), "s": (6, "II"), "u": (3, "I"), "a": (0, "")}
    base = ", ".join(f"{{'c': CAST({c} AS BIGINT), 'a': '{a}'}} AS {s}" for s, (c, a) in tail.items())
    given_role = "CASE WHEN e = 'u' THEN 'assistant' ELSE 'user' END"
    return f"""WITH RECURSIVE
t AS (SELECT coalesce('=' || conv_id, '') AS k, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS place FROM conversations),
-- crc32 by its polynomial, bit by bit
b AS (SELECT place, CAST(4294967295 AS BIGINT) AS c, 1 AS i FROM (SELECT DISTINCT place FROM t)
  UNION ALL SELECT place, list_reduce([xor(c, CAST(ascii(substr(place, i, 1)) AS BIGINT)), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END), i + 1 FROM b WHERE i <= length(place)),
h AS (SELECT place, xor(c, CAST(4294967295 AS BIGINT)) % 20 AS kind FROM b WHERE i = length(place) + 1),
m AS (SELECT k, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy FROM t JOIN h USING (place) WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, left(role, 64), left(text, 64), md5(md5(role) || md5(text)), copy) AS i FROM m),
f AS (SELECT *, left(role, 1) AS initial, regexp_full_match(text, '[ \\t-\\r]*') AS blank,
        row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 AS again, NOT regexp_matches(text, '[.!?][ \\t-\\r]*\\z') AS open FROM o),
r AS (SELECT *, blank OR again AS gone, CASE WHEN open THEN 3 ELSE 0 END AS more, lag(initial) OVER (PARTITION BY k ORDER BY i) || initial AS pair FROM f),
n AS (SELECT k, count(*) AS n, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
        CAST(count(*) FILTER (blank) AS BIGINT) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (open AND NOT gone) AS truncated,
        count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY k),
d AS (SELECT k, n + 1 AS i, {base} FROM n
  UNION ALL SELECT k, i, {", ".join(f"{inserted(s)} AS {s}" for s in given)} FROM (
    SELECT d.k, r.i, {", ".join(f"{edited(s)} AS e_{s}" for s in given)} FROM d JOIN r ON r.k = d.k AND r.i = d.i - 1)),
e AS (SELECT k, z.c AS cost, z.a AS audit FROM d WHERE i = 1),
w AS (SELECT k, audit, 1 AS p, CAST(1 AS BIGINT) AS i, 'z' AS e, CAST([] AS VARCHAR[]) AS said FROM e
  UNION ALL SELECT w.k, audit, p + 1, CASE WHEN x = 'I' THEN w.i ELSE w.i + 1 END,
    CASE x WHEN 'D' THEN e WHEN 'K' THEN r.initial ELSE left({given_role}, 1) END,
    CASE x WHEN 'D' THEN said WHEN 'K' THEN list_append(said, r.role || ':' || r.text)
      WHEN 'R' THEN list_append(said, {given_role} || ':' || r.text) ELSE list_append(said, {given_role} || ':') END
  FROM (SELECT *, substr(audit, p, 1) AS x FROM w WHERE p <= length(audit)) w LEFT JOIN r ON r.k = w.k AND r.i = w.i),
a AS (SELECT k, sha256(array_to_string(said, chr(10))) AS sha FROM w WHERE p = length(audit) + 1)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce('=' || conv_id, '') AS k FROM conversations) c LEFT JOIN n USING (k) LEFT JOIN e USING (k) LEFT JOIN a USING (k)
"""


CONVERSATIONS = _conversations()

ORACLES = {"op11_centroids": CLUSTERS, "op12_conversations": CONVERSATIONS, "op4_suffix_dedup": REPEATS, "op6_embeddings": EMBEDDINGS, "op9_decontaminate": LEAKS}
