"""DuckDB SQL for those queries of this package that SQL can express."""

from __future__ import annotations

from galesol.llm import lloyd, phrases, sharding, url_filter
from galesol.llm.quality_rules import RULES
from galesol.llm.textstats import STOP_WORDS

_SPACE = r"[ \t-\r]"


def _rules_sql() -> str:
    stops = ",".join("'" + f + "'" for f in sorted({f for x in STOP_WORDS for f in (x, x.capitalize())}))
    ok = {}
    for r in RULES:
        ratio = r.top if r.bottom is None else f"({r.top}::DOUBLE / greatest({r.bottom}, 1))"
        ok[r.name] = f"({ratio} BETWEEN {r.least!r}::DOUBLE AND {r.most!r}::DOUBLE OR n_words < {r.min_words})"
    failed = ", ".join(f"CASE WHEN NOT {v} THEN '{k}' END" for k, v in ok.items())
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '{_SPACE}+'), lambda x: x <> '') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, '{_SPACE}', '', 'g') <> '') AS l FROM d),
g AS (SELECT r, i, list_aggregate(list_slice(w, i, i + 4), 'string_agg', ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
p AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
c AS (SELECT r, count(DISTINCT i + k) AS n FROM p, (SELECT unnest(range(5)) AS k) GROUP BY r),
m AS (SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '{_SPACE}', '', 'g')) AS word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, length(t) - length(replace(t, '!', '')) AS n_exclaims,
  len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
  len(list_filter(w, lambda x: x IN ({stops}))) AS n_stop_words FROM w LEFT JOIN c USING (r)),
f AS (SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed, (NOT base_failed AND {" AND ".join(ok.values())}) AS kept, concat_ws(',', {failed}) AS failed_rules
FROM f"""


#: Every row's integer vector, the stated queries against all other rows, five best of each.
_TOP_K = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::HUGEINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, o.vec_id, list_sum(list_transform(list_zip(q.v, o.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v o ON q.r <> o.r AND len(q.v) = len(o.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) <= 5"""

#: A document's bucket has the fewest hash bits at which the bucket's bytes fit.
_SHARDS = f"""
WITH d AS (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS k, coalesce(strlen(text), 0)::BIGINT AS bytes FROM documents),
l AS (SELECT doc_id, bytes, k, x.depth, sum(bytes) OVER w AS shard_bytes, count(*) OVER w AS shard_docs
  FROM d, (SELECT unnest(range({sharding.BITS + 1})) AS depth) x WINDOW w AS (PARTITION BY x.depth, k >> ({sharding.BITS} - x.depth))),
f AS (SELECT *, row_number() OVER (PARTITION BY doc_id, k, bytes ORDER BY depth) AS r FROM l WHERE shard_bytes <= {sharding.QUERY_BYTES} OR depth = {sharding.BITS})
SELECT doc_id, bytes, depth::INTEGER AS depth, right(lpad(bin(k), {sharding.BITS}, '0')[1:depth], 60) AS shard, shard_bytes::BIGINT AS shard_bytes, shard_docs::BIGINT AS shard_docs,
  shard_bytes > {sharding.QUERY_BYTES} AS oversized FROM f WHERE r = 1"""


#: Shingle sets, all pairs that share a shingle, and what links reach.
_NEAR = f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SPACE}+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT w.doc_id, count(s.s) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r(a, b) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT n.doc_id, n.n AS n_shingles, min(r.b) AS component_id, n.doc_id = min(r.b) AS kept FROM n JOIN r ON r.a = n.doc_id GROUP BY n.doc_id, n.n"""


#: Every 400-byte string by its MD5, the starts of repeated ones, the runs they cover, and the bytes between.
_REPEATS = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
h AS (SELECT r, unnest(hs) AS h, unnest(range(len(hs))) AS i FROM (SELECT r, list_transform(range(greatest(octet_length(b) - 399, 0)), lambda i: md5(array_slice(b, i + 1, i + 400))) AS hs FROM d)),
t AS (SELECT r, i FROM h QUALIFY count(*) OVER (PARTITION BY h) > 1),
g AS (SELECT r, i, sum(CASE WHEN i <= p + 400 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS g FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS p FROM t)),
c AS (SELECT r, min(i) AS s, max(i) + 400 AS e FROM g GROUP BY r, g),
k AS (SELECT r, coalesce(lag(e) OVER (PARTITION BY r ORDER BY s), 0) AS a, s AS z FROM c
  UNION ALL SELECT d.r, coalesce(max(e), 0), any_value(octet_length(b)) FROM d LEFT JOIN c USING (r) GROUP BY d.r),
o AS (SELECT r, unhex(string_agg(hex(array_slice(b, a + 1, z)), '' ORDER BY a)) AS kept FROM k JOIN d USING (r) GROUP BY r)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, (octet_length(b) - octet_length(kept))::BIGINT AS n_removed,
  (SELECT count(*) FROM c WHERE c.r = d.r)::BIGINT AS n_spans, sha256(kept) AS kept_sha256 FROM d JOIN o USING (r)"""


_UPPER, _LOWER = url_filter.ASCII_UPPER, url_filter.ASCII_LOWER

#: All phrases of up to four words by plain counting, their worst cuts, what longer ones hold, and the best of each language.
_PHRASES = f"""
WITH p AS (SELECT lang, list_filter(string_split_regex(x, '[ \\t]+'), lambda w: w <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS x FROM documents)),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (SELECT unnest(range(1, {phrases.LONGEST + 1})) AS k) WHERE len(w) >= k)),
c AS MATERIALIZED (SELECT lang, k AS words, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= {phrases.SUPPORT}),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
s AS (SELECT lang, phrase, words, f AS a, string_split(phrase, ' ') AS w FROM c WHERE words > 1),
u AS (SELECT *, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y FROM (SELECT *, unnest(range(1, words)) AS k FROM s)),
v AS (SELECT u.lang, u.phrase, a, l.f AS l, r.f AS r, ((2000000::HUGEINT * a) // (l.f + r.f))::BIGINT AS score FROM u JOIN c l ON l.lang = u.lang AND l.phrase = x JOIN c r ON r.lang = u.lang AND r.phrase = y
  QUALIFY row_number() OVER (PARTITION BY u.lang, u.phrase ORDER BY (2000000::HUGEINT * a) // (l.f + r.f), k) = 1),
b AS (SELECT lang, q, max(a) AS m FROM (SELECT lang, a, array_to_string(w[i:i + z - 1], ' ') AS q FROM (SELECT *, unnest(range(1, words - z + 2)) AS i FROM s, (SELECT unnest(range(2, {phrases.LONGEST})) AS z) WHERE z < words)) GROUP BY ALL)
SELECT v.lang, row_number() OVER (PARTITION BY v.lang ORDER BY score DESC, a DESC, v.phrase) AS rank, v.phrase, a, l, r, n, score FROM v JOIN n ON n.lang = v.lang LEFT JOIN b ON b.lang = v.lang AND b.q = v.phrase
WHERE m IS NULL OR 100::HUGEINT * m < {phrases.INSIDE} * a::HUGEINT QUALIFY row_number() OVER (PARTITION BY v.lang ORDER BY score DESC, a DESC, v.phrase) <= {phrases.TOP}"""


def _lloyd_sql() -> str:
    """Rounds written out one after the other."""
    out = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding, list_transform(embedding, lambda x: floor({lloyd.SCALE} * x::DOUBLE)::HUGEINT) AS v FROM embeddings
  WHERE len(embedding) = {lloyd.DIMS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (SELECT c, v FROM (SELECT v, row_number() OVER (ORDER BY sha256('{lloyd.SEED}:' || vec_id) NULLS LAST, embedding) - 1 AS c FROM v) WHERE c < {lloyd.CLUSTERS})""",
    ]
    for i in range(lloyd.ROUNDS + 1):
        out.append(
            f"""a{i} AS MATERIALIZED (SELECT r, c, d FROM (SELECT r, c, list_sum(list_transform(list_zip(v.v, c{i}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM v, c{i}) QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)"""
        )
        if i < lloyd.ROUNDS:
            out.append(f"""m{i} AS (SELECT c, list(x ORDER BY j) AS v FROM (SELECT c, j, (sum(v[j]) - (sum(v[j]) % count(*) + count(*)) % count(*)) // count(*) AS x FROM a{i} JOIN v USING (r), (SELECT unnest(range(1, {lloyd.DIMS + 1})) AS j) GROUP BY c, j) GROUP BY c)""")
            out.append(f"""c{i + 1} AS MATERIALIZED (SELECT c, coalesce(m{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN m{i} USING (c))""")
    last = lloyd.ROUNDS
    return f"""WITH {", ".join(out)}
SELECT vec_id, a.c::INTEGER AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(list_transform(k.v, lambda x: x::VARCHAR), ',')) AS centroid_sha256 FROM a{last} a JOIN v USING (r) JOIN c{last} k ON k.c = a.c"""


def _urls_sql() -> str:
    """The levels of the tree written out one after the other."""
    u, node = url_filter, "host, prefix"
    rules = sorted(u.RULES, key=lambda r: (-len(r.host) - len(r.path), -len(r.host), r.verdict != "block"))
    case = lambda value: "CASE " + " ".join(f"WHEN (host = '{r.host}' OR host LIKE '%.{r.host}') AND starts_with(path, '{r.path}') THEN {value(r)}" for r in rules) + " END"

    def alike(t: str) -> str:
        node = "host, prefix, lead"
        return f"""SELECT {node}, branch, (terms * all_n / n - n <= free + {u.SIGMAS!r}::DOUBLE * sqrt(2e0 * free) + 1e-6)
    AND (bad - (bad + good) * p) * (bad - (bad + good) * p) <= {u.SIGMAS**2!r}::DOUBLE * (bad + good) * p * (1e0 - p) + 1e-6 AS alike
  FROM (SELECT {node}, branch, sum(n)::DOUBLE AS n, sum(bad)::DOUBLE AS bad, sum(good)::DOUBLE AS good FROM {t} GROUP BY ALL)
  JOIN (SELECT {node}, sum(n)::DOUBLE AS all_n, (sum(bad) + 5e-1) / (sum(bad) + sum(good) + 1e0) AS p, count(DISTINCT tail) - 1 AS free FROM {t} GROUP BY ALL) USING ({node})
  JOIN (SELECT {node}, branch, sum(n::DOUBLE * n / pn) AS terms FROM {t} JOIN (SELECT {node}, tail, sum(n)::DOUBLE AS pn FROM {t} GROUP BY ALL) USING ({node}, tail) GROUP BY ALL) USING ({node}, branch)"""

    out = [
        f"""r AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)""",
        f"""h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r)""",
        f"""g AS (SELECT *, {case(lambda r: f"'{r.host + r.path}'")} AS rule, {case(lambda r: f"'{r.verdict}'")} AS ruled,
  CASE WHEN path = '' THEN []::VARCHAR[] ELSE string_split(substr(regexp_replace(path, '{u.VARIABLE}', '{u.WILD}', 'g'), 2), '/') END AS whole FROM h)""",
        f"""q AS MATERIALIZED (SELECT *, CASE WHEN len(whole) > {u.DEPTH} THEN list_append(whole[1:{u.DEPTH - 1}], array_to_string(whole[{u.DEPTH}:], '/')) ELSE whole END AS segs FROM g)""",
        """s0 AS MATERIALIZED (SELECT host, segs AS shape, segs, '' AS prefix, count(*)::BIGINT AS n, count(CASE WHEN ruled = 'block' THEN 1 END) AS bad, count(CASE WHEN ruled = 'allow' THEN 1 END) AS good FROM q GROUP BY ALL)""",
    ]
    for i in range(u.DEPTH):
        out += [
            f"""l{i} AS (SELECT *, segs[{i + 1}] AS seg, segs[{i + 2}:] AS rest FROM s{i} WHERE len(segs) > {i})""",
            f"""f{i} AS (SELECT {node}, seg FROM (SELECT {node}, seg, sum(n) AS x, sum(sum(n)) OVER (PARTITION BY {node}) AS y FROM l{i} GROUP BY {node}, seg) WHERE x >= {u.MIN_PAGES} AND x >= {u.MIN_SHARE!r}::DOUBLE * y)""",
            f"""b{i} AS MATERIALIZED (SELECT l.*, coalesce(f.seg, '{u.WILD}') AS branch FROM l{i} l LEFT JOIN f{i} f USING ({node}, seg))""",
            f"""t{i} AS MATERIALIZED (SELECT *, first_value(tail) OVER (PARTITION BY {node}, branch ORDER BY n DESC, tail) AS lead
  FROM (SELECT {node}, branch, len(rest) || '/' || coalesce(array_to_string(rest, '/'), '') AS tail, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad, sum(good)::BIGINT AS good FROM b{i} GROUP BY ALL))""",
            f"""x{i} AS MATERIALIZED ({alike(f"t{i}")})""",
            f"""o{i} AS MATERIALIZED (SELECT t.* FROM t{i} t SEMI JOIN (SELECT * FROM x{i} WHERE NOT alike) USING ({node}, branch))""",
            f"""k{i} AS MATERIALIZED (SELECT {node}, lead, branch, 'a' AS g FROM x{i} WHERE alike UNION ALL SELECT {node}, lead, branch, CASE WHEN alike THEN 'b' ELSE '-' || branch END FROM ({alike(f"o{i}")}))""",
            f"""n{i} AS (SELECT {node}, lead, g, CASE WHEN count(*) > 1 THEN '{{' || string_agg(branch, '|' ORDER BY branch) || '}}' ELSE any_value(branch) END AS name FROM k{i} GROUP BY ALL)""",
            f"""s{i + 1} AS MATERIALIZED (SELECT host, shape, segs, prefix || '/' || name AS prefix, n, bad, good FROM b{i} JOIN k{i} USING ({node}, branch) JOIN n{i} USING ({node}, lead, g)
  UNION ALL SELECT host, shape, segs, prefix, n, bad, good FROM s{i} WHERE len(segs) <= {i})""",
        ]
    last = f"s{u.DEPTH}"
    return f"""WITH {", ".join(out)},
prior AS (SELECT coalesce(sum(bad)::DOUBLE / nullif(sum(bad) + sum(good), 0), 0e0) AS p FROM {last}),
pure AS (SELECT host, prefix, (sum(bad) + {u.PRIOR_PAGES!r}::DOUBLE * any_value(p)) / (sum(bad) + sum(good) + {u.PRIOR_PAGES!r}::DOUBLE) AS purity, sum(bad) AS bad FROM {last}, prior GROUP BY ALL)
SELECT page_id, q.host, path, rule, coalesce(ruled, CASE WHEN purity >= {u.MAX_BAD!r}::DOUBLE AND pure.bad > 0 THEN 'block' ELSE 'allow' END) AS verdict, s.prefix AS template, round(purity, 6) AS purity
FROM q JOIN {last} s ON s.host = q.host AND s.shape = q.segs JOIN pure ON pure.host = s.host AND pure.prefix = s.prefix"""


ORACLES: dict[str, str] = {"op11_son_phrases": _PHRASES, "op12_path_templates": _urls_sql(), "op13_dimension_lloyd": _lloyd_sql(), "op9_repeated_substrings": _REPEATS, "op7_circulant_minhash": _NEAR, "op2_va_file": _TOP_K, "op4_extendible_hashing": _SHARDS, "op5_quality_rules": _rules_sql()}
