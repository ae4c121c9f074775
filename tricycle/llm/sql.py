"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from tricycle.llm.filter_audit import LEAST_DISTINCT, LEAST_WORDS, MOST_UPPER
from tricycle.llm.secrets import (
    ACCESS_LENGTH,
    ALLOW,
    ASSIGN_LENGTH,
    CANDIDATE,
    HEX_LENGTH,
    RUNS,
    THRESHOLDS,
    WINDOW,
    most_sum,
    weights,
)
from tricycle.llm.warc import CAPTURES, SCHEME, TRACKING
from tricycle.llm.words import LOWER_SQL, UPPER

LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER_SQL}')"
SIZE = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"


def decontamination(words: int = 10) -> str:
    found = rf"regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {found} AS w FROM documents),
    b AS (SELECT CAST(item_id AS VARCHAR) AS item, {found} AS w FROM benchmark),
    bs AS (SELECT item, w, least(len(w), {words}) AS k FROM b WHERE len(w) > 0),
    bw AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS win
        FROM (SELECT item, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM bs)),
    dw AS (SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS win
        FROM (SELECT r, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
              FROM d, (SELECT DISTINCT k FROM bw) AS ks WHERE len(w) >= k)),
    h AS (SELECT r, i, dw.k, item FROM dw JOIN bw ON bw.win = dw.win AND bw.k = dw.k),
    n AS (SELECT r, count(DISTINCT p) AS n_hit
        FROM (SELECT r, unnest(generate_series(i, i + k - 1)) AS p FROM h) GROUP BY r),
    t AS (SELECT r, list_sort(list(DISTINCT item) FILTER (item IS NOT NULL)) AS items FROM h GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
        CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
        sha256(array_to_string(coalesce(items, []), ',')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN n USING (r) LEFT JOIN t USING (r)"""


def mixing() -> str:
    return f"""
    WITH d AS (SELECT doc_id, source, CAST({SIZE} AS BIGINT) AS size,
        (CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' ||
            CASE WHEN doc_id IS NULL THEN coalesce(text, '') ELSE '' END), 1, 13)) AS BIGINT) + 0.5::DOUBLE)
            / 4503599627370496::DOUBLE AS u FROM documents),
    g AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
    o AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM g),
    f AS (SELECT *, 2.0::DOUBLE * source_size / weight AS fills FROM o),
    c AS (SELECT a.fills, 1.5::DOUBLE * (SELECT sum(source_size)::BIGINT FROM f) AS wanted,
            (SELECT coalesce(sum(source_size), 0)::BIGINT FROM f WHERE f.fills < a.fills) AS inside,
            (SELECT sum(weight) FROM f WHERE f.fills >= a.fills) AS rest FROM (SELECT DISTINCT fills FROM f) AS a),
    l AS (SELECT arg_min((wanted - 2.0::DOUBLE * inside) / rest, fills) AS level FROM c WHERE (wanted - 2.0::DOUBLE * inside) / rest <= fills),
    t AS (SELECT source, source_size,
            least(2.0::DOUBLE * source_size, weight * coalesce((SELECT level FROM l), 'inf'::DOUBLE)) AS target FROM f),
    k AS (SELECT source, length(bin(size)) AS measure, sum(size)::BIGINT AS words FROM d GROUP BY ALL),
    m AS (SELECT k.*, source_size, target,
            (target - 2.0::DOUBLE * (sum(words) OVER (PARTITION BY k.source ORDER BY measure DESC) - words)::BIGINT)
                / nullif((sum(measure * words) OVER (PARTITION BY k.source ORDER BY measure))::BIGINT, 0) AS level
        FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source),
    v AS (SELECT * EXCLUDE (level), CASE WHEN target > 0 THEN least(2.0::DOUBLE, measure * coalesce(
            arg_max(level, measure) FILTER (level * measure <= 2) OVER (PARTITION BY source), 'inf'::DOUBLE)) ELSE 0 END AS expected FROM m),
    x AS (SELECT *, floor(expected)::BIGINT AS certain, expected - floor(expected)::BIGINT AS p FROM v),
    y AS (SELECT *, target - (sum(certain * words) OVER (PARTITION BY source))::BIGINT AS remains FROM x),
    p AS (SELECT d.*, y.* EXCLUDE (source) FROM d JOIN y ON d.source IS NOT DISTINCT FROM y.source AND length(bin(size)) = measure),
    q AS (SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) ELSE 'inf'::DOUBLE END AS q FROM p),
    s AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q)::BIGINT AS until,
            sum(size) OVER (PARTITION BY source, q)::BIGINT AS tied FROM q)
    SELECT doc_id, size, source_size, target,
        size * (certain + CASE WHEN p > 0 AND until - remains <= remains - (until - tied) THEN 1 ELSE 0 END)::BIGINT AS taken
    FROM s"""


def filter_audit() -> str:
    fails = rf"""(len(w) < {LEAST_WORDS})::BIGINT + 2 * (100 * len(list_distinct(w)) < {LEAST_DISTINCT} * len(w))::BIGINT
        + 4 * (100 * len(regexp_extract_all(t, '[A-Z]')) > {MOST_UPPER} * length(t))::BIGINT
        + 8 * regexp_matches(t, '[#$%&*|]')::BIGINT
        + 16 * coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false)::BIGINT"""
    return rf"""
    WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
            regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    f AS (SELECT doc_id, part, {fails} AS mask FROM d),
    l AS (SELECT doc_id, max(coalesce(quality = 1, false)::BIGINT) AS good, max(coalesce(toxic = 1, false)::BIGINT) AS toxic
        FROM labels GROUP BY doc_id),
    c AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
        FROM f LEFT JOIN l USING (doc_id) GROUP BY part, mask),
    k AS (SELECT unnest(string_split('ABCDE', '')) AS x),
    o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM k a, k b, k c, k d, k e
        WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
    s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS letter,
            1 << (ascii(substr(filter_order, step, 1)) - 65) AS bit,
            coalesce(list_sum([1 << (ascii(substr(filter_order, i, 1)) - 65) FOR i IN generate_series(1, step - 1)]), 0)::BIGINT AS prior
        FROM (SELECT filter_order, unnest(generate_series(1, 5)) AS step FROM o)),
    r AS (SELECT part, filter_order, step, letter,
            sum(CASE WHEN mask & (prior | bit) = 0 THEN n ELSE 0 END) AS kept,
            sum(CASE WHEN mask & prior = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
            sum(CASE WHEN mask & prior > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant,
            sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
            sum(CASE WHEN mask & prior = 0 AND mask & bit > 0 THEN good ELSE 0 END) AS good_lost,
            sum(CASE WHEN mask & prior = 0 AND mask & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
        FROM c, s GROUP BY part, filter_order, step, letter)
    SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
        redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
        toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM r"""


def secret_scan() -> str:
    # RE2's (?i) would take letters beyond ASCII too.
    names = "|".join(
        "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in name)
        for name in ("password", "passwd", "secret", "token", "api_?key")
    )
    pattern = rf"(?:{names})[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)"
    table = f"[{', '.join(map(str, weights()))}]"
    # RE2 has no back-references: repeated characters are spelled out.
    symbols = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
    repeats = "|".join(f"[{c}]{{8,}}" if c != "-" else "-{8,}" for c in symbols)
    allow = ALLOW.replace(r"(.)\1{7,}", repeats)
    kinds = [
        ("assign", 0, pattern, f"len(regexp_extract(m, '{pattern}', 1)) >= {ASSIGN_LENGTH}"),
        ("access", 1, f"AKIA[A-Z0-9]{{{ACCESS_LENGTH - 4},}}", "true"),
        ("hex", 2, f"[0-9a-f]{{{HEX_LENGTH},}}", "true"),
        ("candidate", 3, CANDIDATE, "true"),
    ]
    located = " UNION ALL ".join(
        f"""SELECT r, '{name}' AS kind, {order} AS o, m, stop - len(m) AS s, stop AS e FROM (
            SELECT r, m, (sum(len(m) + len(b)) OVER (PARTITION BY r ORDER BY i))::BIGINT AS stop FROM (
                SELECT r, unnest(ms) AS m, unnest(bs[:len(ms)]) AS b, unnest(generate_series(1, len(ms))) AS i FROM (
                    SELECT r, regexp_extract_all(text, '{p}') AS ms, regexp_split_to_array(text, '{p}') AS bs FROM d)
                WHERE len(ms) > 0)) WHERE {keep}"""
        for name, order, p, keep in kinds
    )
    runs = " UNION ".join(
        f"""SELECT r, (p + stop - len(m))::BIGINT, m FROM (
            SELECT r, p, m, sum(len(m) + len(b)) OVER (PARTITION BY r, p ORDER BY i) AS stop FROM (
                SELECT r, p, unnest(ms) AS m, unnest(bs[:len(ms)]) AS b, unnest(generate_series(1, len(ms))) AS i FROM (
                    SELECT r, s AS p, regexp_extract_all(m, '{run}') AS ms, regexp_split_to_array(m, '{run}') AS bs FROM pieces)
                WHERE len(ms) > 0))"""
        for run in RUNS
    )
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    found AS ({located}),
    base AS (SELECT * FROM found WHERE o < 3),
    split AS (SELECT r, s, unnest(regexp_split_to_array(m, '{allow}')) AS b,
            unnest(list_concat(regexp_extract_all(m, '{allow}', 0), [''])) AS x,
            unnest(generate_series(1, len(regexp_split_to_array(m, '{allow}')))) AS i FROM found WHERE o = 3),
    pieces AS (SELECT r, b AS m, (s + sum(len(b) + len(x)) OVER (PARTITION BY r, s ORDER BY i) - len(b) - len(x))::BIGINT AS s
        FROM split),
    parts AS (SELECT r, s, m FROM pieces UNION {runs}),
    cand AS (SELECT r, s, m, row_number() OVER () AS part, CASE
            WHEN regexp_full_match(m, '[0-9a-f]+|[0-9A-F]+') THEN {most_sum(THRESHOLDS['hex'])}
            WHEN regexp_full_match(m, '[0-9a-z]+|[0-9A-Z]+') AND regexp_matches(m, '[0-9][A-Za-z]+[0-9]')
            THEN {most_sum(THRESHOLDS['case'])}
            WHEN regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[0-9]')
            THEN {most_sum(THRESHOLDS['base64'])} END AS t
        FROM parts WHERE len(m) >= {WINDOW}),
    win AS (SELECT r, part, s, t, k, substr(m, k, {WINDOW}) AS w
        FROM (SELECT *, unnest(generate_series(1, len(m) - {WINDOW} + 1)) AS k FROM cand WHERE t IS NOT NULL)),
    sums AS (SELECT r, part, s, t, k, sum({table}[n + 1]) AS total
        FROM (SELECT r, part, s, t, k, ch, count(*) AS n
            FROM (SELECT r, part, s, t, k, unnest(string_split(w, '')) AS ch FROM win) GROUP BY ALL)
        GROUP BY r, part, s, t, k),
    warm AS (SELECT r, s + min(k) - 1 AS s0, s + max(k) - 1 + {WINDOW} AS e0 FROM sums WHERE total <= t GROUP BY r, part, s),
    -- Overlapping ones are one.
    apart AS (SELECT *, s0 >= coalesce(max(e0) OVER (PARTITION BY r ORDER BY s0, e0
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS opens FROM warm),
    hot AS (SELECT r, min(s0) AS s0, max(e0) AS e0 FROM (
        SELECT *, sum(opens::INT) OVER (PARTITION BY r ORDER BY s0, e0 ROWS UNBOUNDED PRECEDING) AS g FROM apart) GROUP BY r, g),
    added AS (SELECT r, 'entropy' AS kind, 3 AS o, s0 AS s, e0 AS e FROM hot
        WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.r = hot.r AND b.s <= s0 AND e0 <= b.e)),
    spans AS (SELECT r, kind, o, s, e FROM base UNION ALL SELECT * FROM added),
    joined AS (SELECT r, count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access,
            count(*) FILTER (o = 2) AS n_hex,
            string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) FILTER (o < 3) AS base_text,
            string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) AS spans FROM spans GROUP BY r)
    SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
        coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base_text, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN joined USING (r)"""


def revisits() -> str:
    number = "CAST('0x' || substr(md5({}), 1, 8) AS BIGINT)".format
    bare = "regexp_replace(trim(url), '#.*$', '')"
    host = f"lower(regexp_extract({bare}, '^{SCHEME}([^/?]*)', 1))"
    host = f"regexp_replace(regexp_replace({host}, '^([^@]*@)?(www[0-9]*[.])?', ''), ':(80|443)$', '')"
    path = f"regexp_replace(regexp_extract({bare}, '^{SCHEME}[^/?]*([^?]*)', 1), '/+$', '')"
    query = f"""array_to_string(list_sort([q for q in string_split(regexp_extract({bare}, '[?](.*)$', 1), '&')
        if q <> '' AND NOT regexp_matches(q, '{TRACKING}')]), '&')"""
    return f"""
    WITH p AS (SELECT page_id, md5(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS n_bytes,
            {host} || {path} AS place, {query} AS query,
            unnest(generate_series(0, {CAPTURES - 1})) AS visit FROM pages WHERE page_id IS NOT NULL),
    h AS (SELECT *, place || CASE WHEN query = '' THEN '' ELSE '?' || query END AS canonical,
            {number("page_id || ':' || visit")} AS h, 1700000000 + {number("CAST(page_id AS VARCHAR)")} % 2592000 AS start FROM p),
    r AS (SELECT page_id * {CAPTURES} + visit AS record_id, canonical, start + visit * (3600 + h % 7200) AS ts, h, start, n_bytes,
            (visit = 0 AND h % 16 > 0) OR (visit > 0 AND h % 8 = 0) AS is_full,
            '"' || CASE WHEN h % 8 = 5 THEN 'x' ELSE '' END || substr(digest, 1, 16) || '"' AS etag FROM h
        WHERE canonical IS NOT NULL),
    o AS (SELECT *, max(CASE WHEN is_full THEN {{'ts': ts, 'record_id': record_id, 'etag': etag, 'start': start, 'n_bytes': n_bytes}} END)
            OVER (PARTITION BY canonical ORDER BY ts, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS f FROM r),
    v AS (SELECT *, CASE WHEN f IS NULL THEN 'missing'
            WHEN h % 8 < 6 THEN CASE WHEN etag = f.etag THEN 'resolved' ELSE 'changed' END
            WHEN h % 8 < 7 THEN CASE WHEN start = f.start THEN 'resolved' ELSE 'changed' END
            ELSE 'unchecked' END AS outcome FROM o WHERE NOT is_full)
    SELECT record_id, canonical, f.record_id AS original_id, outcome, CASE
        WHEN outcome IN ('missing', 'changed') THEN
            'connection: close' || chr(10) || 'content-length: 0' || chr(10) || 'date: ' || ts
            || CASE WHEN h % 8 < 6 THEN chr(10) || 'etag: W/' || etag ELSE '' END
            || CASE WHEN h % 8 < 7 THEN chr(10) || 'last-modified: ' || start ELSE '' END || chr(10) || 'x-cache: ' || (h % 3)
        ELSE 'cache-control: max-age=60' || chr(10) || 'content-length: ' || f.n_bytes || chr(10) || 'content-type: text/html'
            || chr(10) || 'date: ' || ts || chr(10)
            || 'etag: ' || CASE WHEN h % 8 < 6 THEN 'W/' || etag ELSE f.etag END || chr(10)
            || 'last-modified: ' || CASE WHEN h % 8 < 7 THEN start ELSE f.start END || chr(10) || 'x-cache: ' || (h % 3)
        END AS headers FROM v"""
