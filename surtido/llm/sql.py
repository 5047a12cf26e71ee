"""SQL twins of the queries that SQL can express, for DuckDB.

The others use XXH64 or CRC-32, which the twin's database lacks, train a model, or iterate;
the tests compare them with plain forms.
"""

from __future__ import annotations

from surtido.llm.quality import RULES, STOP_WORDS, Rule

_SPACES = "concat(chr(32), chr(9), chr(10), chr(11), chr(12), chr(13))"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_WARC = """
    WITH given AS (
        SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
            sha256(coalesce(html, '')) AS payload_digest FROM pages),
    held AS (
        SELECT payload_digest, min(page_id) AS original FROM given
        WHERE payload_bytes >= 100 GROUP BY payload_digest)
    SELECT page_id, payload_bytes, given.payload_digest,
        CASE WHEN coalesce(page_id <> original, original IS NOT NULL) THEN 'revisit'
            ELSE 'response' END AS record_type,
        CASE WHEN coalesce(page_id <> original, original IS NOT NULL) THEN original END AS refers_to
    FROM given LEFT JOIN held ON given.payload_digest = held.payload_digest"""

_LINES = f"""
    WITH lines AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
            generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
        FROM documents),
    keyed AS (
        SELECT *, translate(trim(line, {_SPACES}), '{_UPPER}', '{_UPPER.lower()}') AS key
        FROM lines),
    judged AS (
        SELECT *, length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS dropped
        FROM keyed)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), ''))
            AS kept_sha256
    FROM judged GROUP BY doc_id"""


def _passes(rule: Rule) -> str:
    ratio = f"{rule.top} / nullif({rule.bottom}, 0)"
    bounds = [f"{ratio} >= {rule.least}"] * (rule.least is not None)
    bounds += [f"{ratio} <= {rule.most}"] * (rule.most is not None)
    return f"coalesce({' AND '.join(bounds) or 'TRUE'}, TRUE)"


_QUALITY = f"""
    WITH given AS (
        SELECT doc_id, coalesce(text, '') AS t, [w FOR w IN string_split_regex(
            coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF w <> ''] AS words,
            [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF trim(x, {_SPACES}) <> '']
                AS lines
        FROM documents),
    windows AS (
        SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS text
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM given)),
    repeated AS (
        SELECT doc_id, i FROM windows
        QUALIFY count(*) OVER (PARTITION BY doc_id, text) > 1),
    covered AS (
        SELECT doc_id, count(DISTINCT p) AS n
        FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM repeated) GROUP BY doc_id),
    measured AS (
        SELECT given.doc_id, CAST(len(words) AS BIGINT) AS n_words,
            CAST(length(translate(t, {_SPACES}, '')) AS BIGINT) AS word_chars,
            CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
            CAST(length(t) - length(translate(t, '!', '')) AS BIGINT) AS n_exclaimed,
            CAST(len([w FOR w IN words IF list_contains([{", ".join(
                f"'{w}'" for w in STOP_WORDS)}], w)]) AS BIGINT) AS n_stop_words,
            CAST(len(lines) AS BIGINT) AS n_lines,
            CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
            CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
        FROM given LEFT JOIN covered ON given.doc_id = covered.doc_id),
    judged AS (
        SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
            {", ".join(f"{_passes(r)} AS ok_{r.name}" for r in RULES)}
        FROM measured)
    SELECT *, NOT base_failed AND {" AND ".join(f"ok_{r.name}" for r in RULES)} AS kept
    FROM judged"""


def _clusters(rounds: int = 10, clusters: int = 8) -> str:
    """Every round is two tables: the nearest centroids, and the floors of the exact means."""
    def nearest(number: int) -> str:
        return f"""
    near{number} AS MATERIALIZED (
        SELECT rid, min(pair).d AS distance, min(pair).cluster AS cluster FROM (
            SELECT rid, {{'d': CAST(sum((e.v - c.v) * (e.v - c.v)) AS BIGINT), 'cluster': cluster}}
                AS pair
            FROM entries e JOIN means{number} c USING (place) GROUP BY rid, cluster)
        GROUP BY rid)"""

    def means(number: int) -> str:
        return f"""
    sums{number} AS (
        SELECT cluster, place, sum(v) AS s, count(*) AS n
        FROM near{number - 1} JOIN entries USING (rid) GROUP BY cluster, place),
    means{number} AS MATERIALIZED (
        SELECT cluster, place, CASE WHEN n IS NULL THEN v ELSE
            CAST((s - ((s % n) + n) % n) // n AS BIGINT) END AS v
        FROM means{number - 1} LEFT JOIN sums{number} USING (cluster, place))"""

    steps = [nearest(0)] + [t(i) for i in range(1, rounds + 1) for t in (means, nearest)]
    return f"""
    WITH kept AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id,
            [CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT) FOR c IN embedding] AS x
        FROM embeddings WHERE len(embedding) = 64
            AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
    entries AS MATERIALIZED (
        SELECT rid, unnest(x) AS v, unnest(range(1, 65)) AS place FROM kept),
    firsts AS MATERIALIZED (
        SELECT rid, row_number() OVER (ORDER BY hash NULLS LAST, x) - 1 AS cluster
        FROM (SELECT *, sha256('3:' || vec_id) AS hash FROM kept)
        ORDER BY cluster LIMIT {clusters}),
    means0 AS MATERIALIZED (
        SELECT CAST(cluster AS INTEGER) AS cluster, place, v FROM firsts JOIN entries USING (rid)),
    {",".join(steps)},
    hashes AS (
        SELECT cluster, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY place)) AS centroid_sha256
        FROM means{rounds} GROUP BY cluster)
    SELECT vec_id, cluster, distance,
        CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
        CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
    FROM near{rounds} JOIN kept USING (rid) JOIN hashes USING (cluster)"""


ORACLES: dict[str, str] = {
    "op4_warc_revisits": _WARC,
    "op5_quality_rules": _QUALITY,
    "op8_line_dedup": _LINES,
    "op13_clustering": _clusters(),
}
