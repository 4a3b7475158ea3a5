"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from fleetgauge.llm.link_trust import RULES, TrustSettings
from fleetgauge.llm.mixing import RANGE, MixSettings

WORDS = r"[^\x20\x09-\x0D]+"


def link_trust(settings: TrustSettings = TrustSettings()) -> str:
    """Rules and two PageRanks, with one pair of steps per iteration."""
    cases = sorted(RULES, key=lambda r: (-len(r.text), r.text))
    fits = [f"((host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}'))"
            for r in cases]
    rule = " ".join(f"WHEN {f} THEN '{r.text}'" for f, r in zip(fits, cases, strict=True))
    verdict = " ".join(f"WHEN {f} THEN '{r.verdict}'" for f, r in zip(fits, cases, strict=True))
    lower = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    start, damping = 1 - settings.damping, settings.damping
    steps = [f"r0 AS (SELECT host, good * {start} AS trust, bad * {start} AS distrust FROM seeds)"]
    for i in range(settings.iterations):
        steps.append(f"""
        r{i + 1} AS (
            SELECT host, sum(trust) AS trust, sum(distrust) AS distrust FROM (
                SELECT dst AS host, trust * forward * {damping} AS trust, 0.0 AS distrust
                FROM steps JOIN r{i} ON src = host
                UNION ALL
                SELECT src, 0.0, distrust * back * {damping} FROM steps JOIN r{i} ON dst = host
                UNION ALL
                SELECT host, good * {start}, bad * {start} FROM seeds)
            GROUP BY host)""")
    return rf"""
    WITH parsed AS (
        SELECT page_id, html,
               translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), {lower}) AS host,
               coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
        FROM pages),
    ruled AS (
        SELECT *, CASE {rule} END AS rule, CASE {verdict} END AS rule_verdict FROM parsed),
    seeds AS (
        SELECT host, (a AND NOT b)::DOUBLE AS good, (b AND NOT a)::DOUBLE AS bad FROM (
            SELECT host, coalesce(bool_or(rule_verdict = 'allow'), false) AS a,
                   coalesce(bool_or(rule_verdict = 'block'), false) AS b
            FROM ruled WHERE host <> '' GROUP BY host) WHERE a <> b),
    links AS (
        SELECT host AS src, dst, count(*)::DOUBLE AS weight FROM (
            SELECT host, unnest(list_distinct(list_transform(regexp_extract_all(html,
                '(?i)href\s*=\s*["'']?\s*[a-z][a-z0-9+.-]*://([^/?#"''\s<>]*)', 1),
                lambda x: translate(x, {lower})))) AS dst FROM ruled)
        WHERE host <> '' AND dst <> '' AND host <> dst GROUP BY 1, 2),
    steps AS (
        SELECT src, dst, weight / sum(weight) OVER (PARTITION BY src) AS forward,
               weight / sum(weight) OVER (PARTITION BY dst) AS back FROM links),
    {",".join(steps)}
    SELECT page_id, p.host, path, rule, coalesce(rule_verdict, CASE
               WHEN coalesce(distrust, 0) > {settings.ratio} * coalesce(trust, 0) THEN 'block'
               ELSE 'allow' END) AS verdict
    FROM ruled p LEFT JOIN r{settings.iterations} r ON p.host = r.host
    """


DECONTAMINATE = r"""
WITH doc_words AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n,
           array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
          FROM item_words WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
doc_windows AS (
    SELECT row, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
    FROM (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, lengths)),
hits AS (SELECT row, i, d.n, item_id FROM doc_windows d JOIN windows USING (n, win)),
hit_words AS (
    SELECT row, count(DISTINCT place) AS n_hit
    FROM (SELECT DISTINCT row, unnest(range(i, i + n)) AS place FROM hits) GROUP BY row),
hit_items AS (
    SELECT row, count(item_id) AS n_items, coalesce(string_agg(item_id, ',' ORDER BY item_id), '') AS ids
    FROM (SELECT DISTINCT row, item_id::VARCHAR AS item_id FROM hits) GROUP BY row)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit_words USING (row) LEFT JOIN hit_items USING (row)
"""


def mix_sources(settings: MixSettings = MixSettings()) -> str:
    weights, n, most = list(settings.weights), len(settings.weights), settings.most
    digits = "('0x' || substr(digest, {}, 12))::BIGINT"
    draw = f"(((first + {{seed}} * step) % {RANGE})::DOUBLE / {float(RANGE)})"
    return rf"""
    WITH sized AS (
        SELECT doc_id, source, size, {digits.format(1)} AS first, {digits.format(13)} AS step FROM (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORDS}')) AS size,
                   sha256(coalesce(doc_id::VARCHAR, sha256(coalesce(text, '')))) AS digest
            FROM documents)),
    sources AS (
        SELECT source, sum(size)::BIGINT AS source_size,
               {weights}[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {n} + 1)::INT] AS weight
        FROM sized GROUP BY source),
    ordered AS (
        SELECT *, sum({most} * source_size) OVER w - {most} * source_size AS before,
               sum(weight) OVER () - sum(weight) OVER w + weight AS open,
               sum(source_size) OVER () * {settings.percent} / 100 AS total
        FROM sources
        WINDOW w AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
    share AS (
        SELECT coalesce(max((total - before) / open) FILTER (
            {most} * source_size > (total - before) / open * weight), 0)::DOUBLE AS share FROM ordered),
    targets AS (
        SELECT source, source_size, least({most} * source_size::DOUBLE, share * weight) AS target
        FROM sources, share),
    rates AS (
        SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targets),
    draws AS (
        SELECT doc_id, r.source, size, seed, floor(rate)
               + ({draw.format(seed="seed")} < rate - floor(rate))::INT AS copies
        FROM sized d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source,
             range({settings.seeds}) AS s(seed)),
    totals AS (
        SELECT t.source, seed, abs(taken - target) AS away FROM (
            SELECT source, seed, sum(size * copies) AS taken FROM draws GROUP BY ALL) t
        JOIN rates r ON t.source IS NOT DISTINCT FROM r.source),
    best AS (
        SELECT source, seed FROM totals
        QUALIFY row_number() OVER (PARTITION BY source ORDER BY away, seed) = 1)
    SELECT doc_id, size, source_size, target, (size * (floor(rate)
           + ({draw.format(seed="seed")} < rate - floor(rate))::INT))::BIGINT AS taken
    FROM sized d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source
    JOIN best b ON d.source IS NOT DISTINCT FROM b.source
    """


EXACT_DUPLICATES = r"""
WITH texts AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
    FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept,
       sha256(t) AS text_sha256
FROM texts
"""


HARD_NEGATIVES = """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
points AS (
    SELECT vec_id, label, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x FROM usable),
scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same,
           list_inner_product(a.x, r.x)::BIGINT AS score
    FROM points a JOIN points r ON a.vec_id <> r.vec_id
    WHERE a.vec_id % 100 = 0),
positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id))::INTEGER
           AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 10
"""


def expected() -> dict[str, str]:
    return {"op2_link_trust": link_trust(), "op7_decontaminate": DECONTAMINATE,
            "op9_mix_sources": mix_sources(), "op11_exact_dedup": EXACT_DUPLICATES,
            "op13_hard_negatives": HARD_NEGATIVES}
