"""SQL with the same results as the package's queries, where SQL can express them."""

from __future__ import annotations

from gradeloom.llm import license_digest, secret_links

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORD = r"[^\x20\x09-\x0D]+"

_TOP_K = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    WHERE q.vec_id % 50 = 0
), r AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

_MIX = rf"""
WITH RECURSIVE docs AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size,
        (CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
    FROM documents
), rows AS (
    SELECT *, CASE WHEN size < 50 THEN 0.5::DOUBLE ELSE 1::DOUBLE END AS preference FROM docs
), sums AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS weight
    FROM rows GROUP BY source
), level(i, level) AS (
    SELECT 0, CAST(sum(source_size) AS DOUBLE) / CAST(sum(weight) AS DOUBLE) FROM sums
    UNION ALL
    SELECT i + 1, CAST(t.total - t.capped AS DOUBLE) / CAST(t.open AS DOUBLE)
    FROM (
        SELECT i, sum(source_size) AS total,
            sum(CASE WHEN 3 * source_size < level * weight THEN 3 * source_size ELSE 0 END) AS capped,
            sum(CASE WHEN 3 * source_size < level * weight THEN 0 ELSE weight END) AS open
        FROM level JOIN sums ON i < 40 GROUP BY i
    ) t
), targets AS (
    SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), (SELECT max_by(level, i) FROM level) * weight) AS target FROM sums
), levels AS (
    SELECT t.source, t.source_size, t.target, r.preference, CAST(sum(r.size) AS BIGINT) AS words
    FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source GROUP BY ALL
), tried AS (
    SELECT *, (target - 3 * coalesce(sum(words) OVER (PARTITION BY source ORDER BY preference DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / nullif(sum(words * preference) OVER (PARTITION BY source ORDER BY preference DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS scale
    FROM levels
), scales AS (
    SELECT source, source_size, target,
        CASE WHEN target > 0 THEN coalesce(max_by(scale, preference) FILTER (scale * preference <= 3), 1e9) ELSE 0 END AS scale
    FROM tried GROUP BY source, source_size, target
), plan AS (
    SELECT s.source, s.source_size, s.target, s.scale,
        s.target - sum(floor(least(3::DOUBLE, s.scale * l.preference)) * l.words) AS budget
    FROM scales s JOIN levels l ON s.source IS NOT DISTINCT FROM l.source GROUP BY s.source, s.source_size, s.target, s.scale
), parted AS (
    SELECT r.*, p.source_size, p.target, p.budget, least(3::DOUBLE, p.scale * r.preference) AS copies
    FROM rows r JOIN plan p ON r.source IS NOT DISTINCT FROM p.source
), odds AS (
    SELECT *, floor(copies) AS whole, copies - floor(copies) AS p,
        CASE WHEN copies > floor(copies) THEN (u / (1 - u)) * ((1 - (copies - floor(copies))) / (copies - floor(copies))) END AS odds
    FROM parted
), placed AS (
    SELECT *, odds / (1 + odds) * 32768 AS place FROM odds
), upto AS (
    SELECT *, sum(CASE WHEN p > 0 THEN size END) OVER (PARTITION BY source, p > 0 ORDER BY place, doc_id, size) AS upto FROM placed
), first AS (
    SELECT *, p > 0 AND upto <= budget AS chosen FROM upto
), gap_1 AS (
    SELECT source, max(budget) - sum(CASE WHEN chosen THEN size ELSE 0 END) AS gap FROM first GROUP BY source
), fill_1 AS (
    SELECT f.source, arg_max(f.doc_id, (f.size, f.place, f.doc_id)) AS doc_id
    FROM first f JOIN gap_1 g ON f.source IS NOT DISTINCT FROM g.source
    WHERE NOT f.chosen AND f.p > 0 AND f.size > 0 AND f.size <= g.gap GROUP BY f.source
), second AS (
    SELECT f.* REPLACE (f.chosen OR x.doc_id IS NOT NULL AS chosen)
    FROM first f LEFT JOIN fill_1 x ON f.doc_id = x.doc_id
), gap_2 AS (
    SELECT source, max(budget) - sum(CASE WHEN chosen THEN size ELSE 0 END) AS gap FROM second GROUP BY source
), fill_2 AS (
    SELECT f.source, arg_max(f.doc_id, (f.size, f.place, f.doc_id)) AS doc_id
    FROM second f JOIN gap_2 g ON f.source IS NOT DISTINCT FROM g.source
    WHERE NOT f.chosen AND f.p > 0 AND f.size > 0 AND f.size <= g.gap GROUP BY f.source
)
SELECT f.doc_id, f.size, f.source_size, f.target,
    CAST((f.whole + CASE WHEN f.chosen OR x.doc_id IS NOT NULL THEN 1 ELSE 0 END) * f.size AS BIGINT) AS taken
FROM second f LEFT JOIN fill_2 x ON f.doc_id = x.doc_id
"""

_PHRASES = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', lower('{_UPPER}')), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
    SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang
), grams AS (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM words CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k
), f AS (
    SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30
), cuts AS (
    SELECT c.lang, c.k, c.phrase, c.a, cut, string_split(c.phrase, ' ') AS w FROM f c, unnest(range(1, c.k)) t(cut) WHERE c.k > 1
), valued AS (
    SELECT c.lang, c.k, c.phrase, c.a, cut, l.a AS l, r.a AS r,
        CAST(CAST(2000000 AS HUGEINT) * c.a // (CAST(l.a AS HUGEINT) + r.a) AS BIGINT) AS score
    FROM cuts c
    JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:cut], ' ')
    JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[cut + 1:c.k], ' ')
), best AS (
    SELECT * FROM valued QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), around AS (
    SELECT s.lang, s.phrase FROM f s JOIN f x ON x.lang = s.lang AND x.k > s.k
        AND contains(' ' || x.phrase || ' ', ' ' || s.phrase || ' ') AND 100 * x.a >= 80 * s.a
    WHERE s.k > 1 GROUP BY ALL
)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank, b.phrase, a, l, r, n, score
FROM best b JOIN totals USING (lang) ANTI JOIN around z ON z.lang = b.lang AND z.phrase = b.phrase
QUALIFY rank <= 2000
"""

_NEAR = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', lower('{_UPPER}')), '{_WORD}') AS w FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
    FROM words
), sized AS (
    SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets
), flat AS (
    SELECT doc_id, unnest(s) AS shingle FROM sets
), shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
    FROM flat x JOIN flat y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sized p ON p.doc_id = a JOIN sized q ON q.doc_id = b WHERE 100 * k >= 75 * (p.n + q.n - k)
), reach(a, b) AS (
    SELECT doc_id, doc_id FROM sized
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), owners AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sized JOIN owners USING (doc_id)
"""

_LEAKS = rf"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '{_WORD}') AS w FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '{_WORD}') AS w FROM benchmark
), items AS (
    SELECT item_id, least(len(w), 5) AS n,
        unnest(list_distinct(list_transform(range(1, len(w) - least(len(w), 5) + 2), lambda i: array_to_string(w[i:i + least(len(w), 5) - 1], ' ')))) AS shingle
    FROM b WHERE len(w) > 0
), sizes AS (
    SELECT item_id, count(*) AS n_item FROM items GROUP BY item_id
), runs AS (
    SELECT doc_id, k.n, unnest(list_distinct(list_transform(range(1, len(w) - k.n + 2), lambda i: array_to_string(w[i:i + k.n - 1], ' ')))) AS shingle
    FROM d, (SELECT DISTINCT n FROM items) k WHERE len(w) >= k.n
), held AS (
    SELECT doc_id, item_id, count(*) AS n_shared FROM runs JOIN items USING (n, shingle) GROUP BY ALL
)
SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment
FROM held JOIN sizes USING (item_id) WHERE 100 * n_shared >= 75 * n_item
"""

ORACLES: dict[str, str] = {
    "op1_nra_topk": _TOP_K,
    "op2_pareto_mix": _MIX,
    "op4_bbit_minhash": _NEAR,
    "op7_decontaminate": _LEAKS,
}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(line: str) -> str:
    text = f"regexp_replace(lower({line}), '{license_digest.NOT_WORDS}', ' ', 'g')"
    for pattern, one in license_digest.SPELLINGS:
        text = f"regexp_replace({text}, '{pattern}', '{one}', 'g')"
    return f"CASE WHEN regexp_matches(lower({line}), '{license_digest.COPYRIGHT_LINE}') THEN '' ELSE trim({text}) END"


_LINES = f"list_filter(list_transform(string_split_regex(coalesce(text, ''), '{license_digest.BREAKS}'), lambda l: {_canonical('l')}), lambda l: l <> '')"
_KNOWN = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, texts in license_digest.KNOWN.items() for text in texts)

_LICENSES = f"""
WITH known AS (
    SELECT DISTINCT license, sha256(array_to_string({_LINES}, ' ')) AS digest FROM (VALUES {_KNOWN}) k(license, text)
), docs AS (
    SELECT doc_id, {_LINES} AS lines FROM documents
), wholes AS (
    SELECT doc_id, sha256(array_to_string(lines, ' ')) AS text_digest FROM docs
), units AS (
    SELECT doc_id, sha256(unnest(lines)) AS digest FROM docs
), found AS (
    SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS line_licenses, count(*) AS n FROM units JOIN known USING (digest) GROUP BY doc_id
), matched AS (
    SELECT doc_id, string_agg(license, ',' ORDER BY license) AS text_license FROM wholes JOIN known ON digest = text_digest GROUP BY doc_id
)
SELECT doc_id, text_digest, text_license, line_licenses, coalesce(n, 0) AS n_license_lines
FROM wholes LEFT JOIN found USING (doc_id) LEFT JOIN matched USING (doc_id)
"""

ORACLES["op8_license_digest"] = _LICENSES


def _found(kind: str, pattern: str, group: int = 0) -> str:
    quoted = _quoted(pattern)
    return f"""SELECT rid, '{kind}' AS found, string_split_regex(t, {quoted}) AS g,
        regexp_extract_all(t, {quoted}, 0) AS x, regexp_extract_all(t, {quoted}, {group}) AS c FROM d"""


_SECRETS = f"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), m AS (
    {_found('assign', secret_links.ASSIGN, 2)}
    UNION ALL {_found('access', secret_links.ACCESS)}
    UNION ALL {_found('hex', secret_links.HEX)}
    UNION ALL {_found('name', secret_links.NAME)}
    UNION ALL {_found('endpoint', secret_links.ENDPOINT)}
), p AS (
    SELECT rid, found, unnest(range(1, len(x) + 1)) AS i, unnest(g[1:len(x)]) AS gap, unnest(x) AS hit, unnest(c) AS core FROM m
), q AS (
    SELECT rid, found, length(core) AS core, length(hit) AS size,
        CAST(sum(length(gap) + length(hit)) OVER (PARTITION BY rid, found ORDER BY i) AS BIGINT) AS stop
    FROM p
), parts AS (
    SELECT rid, stop - size AS start, stop, CASE
        WHEN found = 'hex' THEN 'hex'
        WHEN found = 'assign' AND core >= {secret_links.ASSIGN_LEAST} THEN 'assign'
        WHEN found = 'access' AND core >= {secret_links.ACCESS_LEAST} THEN 'access'
        WHEN found = 'assign' AND core >= {secret_links.WEAK_ASSIGN_LEAST} THEN 'link_secret'
        WHEN found = 'name' OR found = 'access' AND core >= {secret_links.WEAK_ACCESS_LEAST} THEN 'link_id'
        WHEN found = 'endpoint' THEN 'link_endpoint' END AS kind
    FROM q
), near AS (
    SELECT w.rid, w.start, w.stop, w.kind,
        bool_or(o.kind IN ('access', 'link_id')) AS id,
        bool_or(o.kind IN ('assign', 'hex', 'link_secret')) AS secret,
        bool_or(o.kind = 'link_endpoint') AS endpoint
    FROM parts w JOIN parts o ON w.rid = o.rid AND abs(w.start - o.start) <= {secret_links.REACH}
    WHERE starts_with(w.kind, 'link_') GROUP BY ALL
), kept AS (
    SELECT rid, start, stop, kind FROM parts WHERE NOT starts_with(kind, 'link_')
    UNION ALL SELECT rid, start, stop, kind FROM near
    WHERE CASE kind WHEN 'link_id' THEN secret WHEN 'link_secret' THEN id OR endpoint ELSE id AND secret END
), named AS (
    SELECT *, kind || ':' || start || ':' || stop AS span,
        list_position(['assign', 'access', 'hex', 'link_id', 'link_secret', 'link_endpoint'], kind) AS place FROM kept
), listed AS (
    SELECT rid, string_agg(span, ',' ORDER BY start, place, stop) AS spans,
        string_agg(span, ',' ORDER BY start, place, stop) FILTER (NOT starts_with(kind, 'link_')) AS base,
        count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex
    FROM named GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN listed USING (rid)
"""

ORACLES["op3_secret_links"] = _SECRETS
ORACLES["op11_lead_rollup"] = _PHRASES
