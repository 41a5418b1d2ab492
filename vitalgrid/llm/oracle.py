"""SQL counterparts of the named queries, where SQL expresses them."""

from .url_rules import PATTERN_RULES

# words of a text, NULL and blank texts have none
_WORDS = r"list_filter(regexp_split_to_array(coalesce({0}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def _counts() -> str:
    """CTEs up to `counts`: the base counts of every document."""
    return rf"""
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, lang, source,
        {_WORDS.format('text')} AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents),
win AS (SELECT r, i, w[i:i+4] AS s FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
again AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, s) > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM again, range(5) t(k) GROUP BY r),
counts AS (SELECT d.r, doc_id, lang, source, len(w)::BIGINT AS n_words,
        coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines,
        coalesce(rep.n, 0)::BIGINT AS n_repeat_words
    FROM d LEFT JOIN rep ON rep.r = d.r),
base AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts)"""


# measure, its value, percents of the lower (0: none) and the upper quantile
_MEASURES = (
    ("s", "n_symbols * 1000 // greatest(n_words, 1)", 0, 85),
    ("d", "n_dup_lines * 1000 // greatest(n_lines, 1)", 0, 99),
    ("l", "word_chars * 100 // greatest(n_words, 1)", 15, 85),
)


def _quantiles(name: str, by: str) -> str:
    """Lower, middle and upper quantile per group and measure from the bucket counts."""
    key = f"{by}," if by else ""
    return f"""
{name}_m AS (SELECT {key} measure, low, high, bucket, sum(n) AS n FROM sketch GROUP BY ALL),
{name}_r AS (SELECT *, sum(n) OVER (PARTITION BY {key} measure ORDER BY bucket) AS upto,
        sum(n) OVER (PARTITION BY {key} measure) AS total FROM {name}_m),
{name} AS (SELECT {key} measure, max(total)::BIGINT AS docs, min(bucket) FILTER (100 * upto >= low * total) AS ql,
        min(bucket) FILTER (100 * upto >= 50 * total) AS qm, min(bucket) FILTER (100 * upto >= high * total) AS qh
    FROM {name}_r GROUP BY ALL)"""


def quality(final: str) -> str:
    """The quality rules up to `judged`, then `final`."""
    bits = "greatest(length(bin(v)) - 6, 0)"
    join = " AND ".join(f"coalesce('=' || {{0}}.{c}, '') = coalesce('=' || j.{c}, '')" for c in ("lang", "source"))
    lang = join.split(" AND ")[0]
    values = ", ".join(f"{{'measure': '{m}', 'low': {low}, 'high': {high}, 'v': {v}}}" for m, v, low, high in _MEASURES)
    blend = ", ".join(
        f"(o.docs * o.{q} + 50 * ((l.docs * l.{q} + 50 * a.{q}) // (l.docs + 50))) // (o.docs + 50) AS {q}"
        for q in ("ql", "qm", "qh"))
    return f"""
WITH {_counts()},
vals AS (SELECT r, lang, source, base_failed, unnest([{values}], max_depth := 2) FROM base),
sketch AS (SELECT lang, source, measure, low, high, ((v >> {bits}) << {bits}) AS bucket, count(*) AS n
    FROM vals WHERE NOT base_failed GROUP BY ALL),
{_quantiles('of_own', 'lang, source')}, {_quantiles('of_lang', 'lang')}, {_quantiles('of_all', '')},
outside AS (SELECT DISTINCT j.r
    FROM (SELECT *, ((v >> {bits}) << {bits}) AS b FROM vals) j
    JOIN of_own o ON o.measure = j.measure AND {join.format('o')}
    JOIN of_lang l ON l.measure = j.measure AND {lang.format('l')}
    JOIN of_all a ON a.measure = j.measure,
    LATERAL (SELECT {blend}) q
    WHERE j.b > q.qh + 5 * (q.qh - q.qm) OR j.low > 0 AND j.b < q.ql - 5 * (q.qm - q.ql)),
judged AS (SELECT *, NOT base_failed AND r NOT IN (SELECT r FROM outside) AS kept FROM base)
{final}"""


def jaccard(docs: str) -> str:
    """CTEs up to `component(doc_id, n_shingles, component_id)` over the relation `docs`."""
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
jd AS (SELECT doc_id, {_WORDS.format(lowered)} AS w FROM {docs}),
sh AS (SELECT DISTINCT doc_id, s FROM (
        SELECT doc_id, array_to_string(w[i:i+4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM jd)
        UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM jd WHERE len(w) BETWEEN 1 AND 4)),
sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id
    GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS id, doc_id AS other FROM {docs} UNION SELECT reach.id, links.b FROM reach JOIN links ON links.a = reach.other),
component AS (SELECT id AS doc_id, coalesce(any_value(sizes.n), 0)::BIGINT AS n_shingles, min(other) AS component_id
    FROM reach LEFT JOIN sizes ON sizes.doc_id = id GROUP BY 1)"""


def containment(docs: str) -> str:
    """CTEs up to `leaks(doc_id, item_id, n_item_shingles, n_found)` over the relation `docs`."""
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def shingles(name, key):
        return f"""(SELECT DISTINCT {key}, k, array_to_string(w[i:i+k-1], ' ') AS s
        FROM (SELECT {key}, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM {name}))"""

    return rf"""
bi AS (SELECT item_id, w, least(len(w), 5) AS k FROM (SELECT item_id, {_WORDS.format(lowered)} AS w FROM benchmark) WHERE len(w) > 0),
bs AS {shingles('bi', 'item_id')},
bn AS (SELECT item_id, count(*) AS n FROM bs GROUP BY 1),
dw AS (SELECT doc_id, k, {_WORDS.format(lowered)} AS w FROM {docs}, (SELECT DISTINCT k FROM bi)),
ds AS {shingles('dw', 'doc_id')},
leaks AS (SELECT doc_id, item_id, any_value(n)::BIGINT AS n_item_shingles, count(*)::BIGINT AS n_found
    FROM ds JOIN bs USING (k, s) JOIN bn USING (item_id) GROUP BY 1, 2 HAVING 100 * count(*) >= 80 * any_value(n))"""


def mixture(docs: str, sweeps: int = 400) -> str:
    """CTEs up to `mixed(doc_id, topic, tokens, expected, copies)` over the relation `docs`."""
    dimensions = ("source", "lang", "topic")
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    targets = ", ".join(
        f"""raw_{d} AS (SELECT {d}, pow(sum(tokens) / (SELECT sum(tokens) FROM cell0), 0.8) AS x FROM cell0 GROUP BY 1),
t_{d} AS (SELECT {d}, x / (SELECT sum(x) FROM raw_{d}) AS t_{d} FROM raw_{d})"""
        for d in dimensions
    )

    def fitted(d, inner):
        return f"SELECT * REPLACE (weight * t_{d} / sum(weight) OVER (PARTITION BY {d}) AS weight) FROM ({inner})"

    step = "SELECT * FROM ipf WHERE sweep < {}".format(sweeps)
    for d in dimensions:
        step = fitted(d, step)
    return rf"""
md AS (SELECT doc_id, coalesce('=' || source, '') AS source, coalesce('=' || lang, '') AS lang,
        CASE WHEN regexp_matches({low}, 'license|licence|copyright|all rights reserved') THEN 'legal'
            WHEN regexp_matches({low}, '[a-z0-9]@[a-z0-9-]+\.[a-z]') THEN 'contact'
            WHEN regexp_matches({low}, '[0-9]') THEN 'figures' ELSE 'prose' END AS topic,
        len({_WORDS.format('text')})::BIGINT AS tokens,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'text ' || md5(text), '')), 1, 13))::BIGINT / pow(2, 52) AS draw FROM {docs}),
cell0 AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM md GROUP BY ALL HAVING sum(tokens) > 0),
{targets},
ipf AS (SELECT 0 AS sweep, source, lang, topic, tokens, tokens AS weight, t_source, t_lang, t_topic
        FROM cell0 JOIN t_source USING (source) JOIN t_lang USING (lang) JOIN t_topic USING (topic)
    UNION ALL SELECT sweep + 1, * EXCLUDE (sweep) FROM ({step})),
fit AS (SELECT * FROM ipf WHERE sweep = {sweeps}),
chance AS (SELECT source, lang, topic, 0.5e0 * (sum(tokens) OVER ()) / (sum(weight) OVER ()) * weight / tokens AS expected FROM fit),
mixed AS (SELECT doc_id, topic, tokens, expected, (floor(expected) + (draw < expected - floor(expected))::INT)::INT AS copies
    FROM (SELECT md.* , CASE WHEN tokens > 0 THEN coalesce(chance.expected, 0) ELSE 0 END AS expected
        FROM md LEFT JOIN chance USING (source, lang, topic)))"""


def substring_dedup() -> str:
    return f"""
WITH d AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
win AS (SELECT doc_id, i, w[i:i+12] AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
firsts AS (SELECT s, min(doc_id) AS first FROM win GROUP BY 1),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM win JOIN firsts USING (s), range(13) t(k) WHERE first < doc_id),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


def url_filter() -> str:
    rest = "coalesce(regexp_extract(url, '(?s)://(.*)$', 1), '')"
    lowered = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    fits = []
    for host, path in (("example.net", "/en/"), ("example.com", "/de/"), ("org", "/fr/"), ("net", "/")):  # longest first
        fits.append(f"WHEN ('.' || host) LIKE '%.{host}' AND starts_with(path, '{path}') THEN '{host}{path}'")
    patterns = " ".join(
        f"WHEN regexp_matches(host || path, '{r.pattern}') THEN '{r.name}'"
        for r in sorted(PATTERN_RULES, key=lambda r: (len(r.name), r.name), reverse=True)
    )
    return f"""
WITH p AS (SELECT page_id, translate(regexp_extract({rest}, '^[^/?#]*', 0), {lowered}) AS host,
        regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1) AS path FROM pages),
r AS (SELECT *, CASE {' '.join(fits)} END AS rule, CASE {patterns} END AS pattern FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IS NULL THEN pattern END AS pattern,
    CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
        WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM r"""


SQL = {
    "op1_quality_rules": quality(
        "SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged"
    ),
    "op3_jaccard_join": f"WITH RECURSIVE {jaccard('documents')} SELECT * FROM component",
    "op5_mixture": f"""WITH RECURSIVE {mixture('documents')}
SELECT doc_id, topic, tokens, round(expected, 6) AS expected, true AS calibrated, copies FROM mixed""",
    "op6_substring_dedup": substring_dedup(),
    "op7_url_filter": url_filter(),
    "op10_decontamination": f"WITH {containment('documents')} SELECT * FROM leaks",
}
