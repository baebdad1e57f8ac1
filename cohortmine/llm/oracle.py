"""DuckDB SQL of the operators that SQL can express, written against the contracts."""

from __future__ import annotations

from cohortmine.llm import collocations as co
from cohortmine.llm import lexical_search as ls
from cohortmine.llm import mixing as mx
from cohortmine.llm import quality_rules as qr
from cohortmine.llm import secret_scan as sc

_WORD = r"[^\x20\x09-\x0D]+"


def _q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


OP9 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '{_WORD}') AS ws FROM d),
win AS (SELECT rid, unnest(range(1, len(ws) - 1)) AS p, ws FROM w WHERE len(ws) >= 3),
tri AS (SELECT rid, p, ws[p] AS a, ws[p + 1] AS b, ws[p + 2] AS c FROM win),
dup AS (SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM tri) WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT q) AS n FROM (SELECT rid, unnest([p, p + 1, p + 2]) AS q FROM dup) GROUP BY rid),
ln AS (SELECT rid, source, t, l FROM (SELECT rid, source, t, unnest(string_split(t, chr(10))) AS l FROM d)
       WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
dl AS (SELECT rid, count(*) - count(DISTINCT l) AS n FROM ln GROUP BY rid),
nl AS (SELECT rid, source, t, trim(regexp_replace(lower(l), '[\x20\x09-\x0D]+', ' ', 'g')) AS k,
              len(regexp_extract_all(l, '{_WORD}')) AS n FROM ln),
hosts AS (SELECT source, count(DISTINCT t) AS all_docs FROM d GROUP BY source),
freq AS (SELECT nl.source, k FROM nl JOIN hosts ON nl.source IS NOT DISTINCT FROM hosts.source
         GROUP BY nl.source, k, all_docs
         HAVING count(DISTINCT t) >= {qr.LINE_MIN_DOCS} AND count(DISTINCT t) > {qr.LINE_SHARE} * all_docs),
gone AS (SELECT rid FROM nl LEFT JOIN freq ON nl.source IS NOT DISTINCT FROM freq.source AND nl.k = freq.k
         GROUP BY rid HAVING sum(CASE WHEN freq.k IS NULL THEN n ELSE 0 END) < {qr.DEPLETED_SHARE} * sum(n)),
one AS (SELECT d.rid, doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
          len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
          coalesce(dl.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
          gone.rid IS NOT NULL AS is_gone
        FROM d JOIN w ON d.rid = w.rid LEFT JOIN dl ON d.rid = dl.rid LEFT JOIN rep ON d.rid = rep.rid
        LEFT JOIN gone ON d.rid = gone.rid),
two AS (SELECT *, n_words < {qr.MIN_WORDS} OR 100 * n_repeat_words > {qr.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM one)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT is_gone AS kept FROM two
"""

OP6 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
r AS (SELECT rid, doc_id, source, md5(t) AS h, len(regexp_extract_all(t, '{_WORD}'))::BIGINT AS size,
        CASE WHEN t = '' THEN 0.1 ELSE greatest(ceil((1 - len(regexp_extract_all(t, '[0-9#*$%&|<>]'))::DOUBLE
             / length(t)) * 10) / 10, 0.1) END::DOUBLE AS q,
        ((('0x' || substr(md5('{mx.SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(t)), 1, 13))::BIGINT)::DOUBLE
             + 0.5) / 4503599627370496.0 AS u FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM r GROUP BY source),
w AS (SELECT *, {[float(x) for x in mx.WEIGHTS]}[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mx.WEIGHTS)} + 1)::INT] AS w,
        {float(mx.MAX_EPOCHS)} * source_size AS cap FROM s),
c AS (SELECT *, sum(source_size) OVER () AS total, cap / w AS ratio,
        coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
        sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free FROM w),
rate AS (SELECT (total - held) / free AS l FROM c WHERE ratio >= (total - held) / free ORDER BY ratio, source NULLS LAST LIMIT 1),
aims AS (SELECT source, source_size, least(cap, l * w)::DOUBLE AS target FROM w, rate),
e AS (SELECT r.*, source_size, target,
        CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs, -ln(u) / q AS key
      FROM r JOIN aims ON r.source IS NOT DISTINCT FROM aims.source),
k AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, h ROWS UNBOUNDED PRECEDING) - size / 2.0 AS mid FROM e)
SELECT doc_id, size, source_size, target,
  CASE WHEN size = 0 THEN 0 ELSE size * (epochs + CASE WHEN mid <= target - epochs * source_size THEN 1 ELSE 0 END) END::BIGINT AS taken
FROM k
"""


def _found(kind: str, pattern: str, group: int = 0) -> str:
    """Matches of one kind with their start (0-based code points) from the gaps between them."""
    p = _q(pattern)
    return rf"""
  SELECT rid, '{kind}' AS kind, v,
    (sum(length(g) + length(m)) OVER (PARTITION BY rid ORDER BY i) - length(m))::BIGINT AS s,
    (sum(length(g) + length(m)) OVER (PARTITION BY rid ORDER BY i))::BIGINT AS e
  FROM (SELECT rid, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS m, unnest(gs[1:len(ms)]) AS g, unnest(vs) AS v
        FROM (SELECT rid, regexp_extract_all(t, {p}) AS ms, regexp_extract_all(t, {p}, {group}) AS vs,
                     string_split_regex(t, {p}) AS gs FROM d) WHERE len(ms) > 0)"""


OP4 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join([_found("assign", sc.ASSIGN, 2), _found("access", sc.ACCESS), _found("hex", "[0-9a-f]+"),
                           _found("weak_id", sc.WEAK_ID), _found("weak_secret", sc.WEAK_SECRET),
                           _found("endpoint", sc.ENDPOINT)])}),
k AS (SELECT rid, s, e, CASE WHEN kind = 'assign' AND length(v) < 8 THEN 'weak_secret'
        WHEN kind = 'access' AND length(v) < 16 THEN 'weak_id' ELSE kind END AS kind
      FROM m WHERE kind <> 'hex' OR length(v) >= 32),
p AS (SELECT DISTINCT *, CASE WHEN kind IN ('access', 'weak_id') THEN 'id' WHEN kind = 'endpoint' THEN 'endpoint'
        ELSE 'secret' END AS part FROM k),
x AS (SELECT a.* FROM p a WHERE kind IN ('assign', 'access', 'hex')
      OR ((part = 'id' OR EXISTS (SELECT 1 FROM p b WHERE b.rid = a.rid AND b.part = 'id' AND abs(a.s - b.s) <= {sc.SCOPE}))
          AND (part = 'secret' OR EXISTS (SELECT 1 FROM p b WHERE b.rid = a.rid AND b.part = 'secret' AND abs(a.s - b.s) <= {sc.SCOPE})))),
y AS (SELECT *, list_position({list(sc.KINDS)}, kind) AS r FROM x),
z AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
        count(*) FILTER (kind = 'hex') AS n_hex,
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, r, e) FILTER (r <= 3) AS base,
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, r, e) AS spans FROM y GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN z ON d.rid = z.rid
"""

_LOW = f"'{ls.UPPER}', '{ls.LOWER}'"

OP11 = rf"""
WITH p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece
           FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), {_LOW}) AS t FROM documents)),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
pos AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w WHERE len(ws) > 0),
g AS (SELECT lang, unnest([1, 2, 3]) AS k, ws, i FROM pos),
f AS (SELECT lang, k, ws[i:i + k - 1] AS x, count(*)::BIGINT AS a FROM g WHERE i + k - 1 <= len(ws) GROUP BY lang, k, x),
tot AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND a >= {co.MIN_COUNT}),
cuts AS (SELECT c.lang, c.k, c.x, c.a, unnest(range(1, c.k)) AS cut FROM c),
sc AS (SELECT cuts.*, lf.a AS l, rf.a AS r, ((1000000::HUGEINT * cuts.a * cuts.a) // (lf.a::HUGEINT * rf.a))::BIGINT AS score
       FROM cuts JOIN f lf ON lf.lang = cuts.lang AND lf.x = cuts.x[1:cut]
                 JOIN f rf ON rf.lang = cuts.lang AND rf.x = cuts.x[cut + 1:cuts.k]),
low AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY lang, x ORDER BY score, cut) = 1),
inner2 AS (SELECT lang, unnest([x[1:2], x[2:3]]) AS x, a FROM c WHERE k = 3),
longer AS (SELECT lang, x, max(a) AS m FROM inner2 GROUP BY lang, x),
shown AS (SELECT low.* FROM low LEFT JOIN longer ON low.lang = longer.lang AND low.x = longer.x
          WHERE m IS NULL OR 100 * m < {co.HIDDEN_PERCENT} * low.a)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, array_to_string(x, ' ')) AS rank,
       array_to_string(x, ' ') AS phrase, a, l, r, tot.n AS n, score
FROM shown s JOIN tot ON tot.lang = s.lang QUALIFY rank <= {co.TOP}
"""

OP12 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), {_LOW}), '{ls.TERM}') AS ts FROM documents),
st AS (SELECT count(*)::BIGINT AS nd, sum(len(ts))::BIGINT AS ld FROM d WHERE len(ts) > 0),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {_LOW}), '{ls.TERM}')) AS term FROM benchmark),
o AS (SELECT rid, doc_id, len(ts)::BIGINT AS n, unnest(ts) AS term FROM d),
tf AS (SELECT rid, doc_id, n, term, count(*)::BIGINT AS tf FROM o WHERE term IN (SELECT term FROM i) GROUP BY rid, doc_id, n, term),
w AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, st GROUP BY term, nd),
s AS (SELECT i.item_id, rid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + ((90 * n * nd) // ld)))))::BIGINT AS score
      FROM i JOIN w ON i.term = w.term JOIN tf ON tf.term = w.term, st GROUP BY i.item_id, rid, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= {ls.TOP}
"""
