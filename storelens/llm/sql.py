"""DuckDB SQL of the operators that SQL can express: the same results by plain joins over all pairs."""

from __future__ import annotations

import string

from .urls import LINK, RULES, UNIT

_LOWER = f"'{string.ascii_uppercase}', '{string.ascii_lowercase}'"


def _components(nodes: str, links: str) -> str:
    """CTEs that end in ``parts`` (node, component); ``links`` has (a, b)."""
    return f"""
        sides AS (SELECT a, b FROM {links} UNION ALL SELECT b, a FROM {links}),
        reached(node, root) AS (SELECT a, a FROM sides UNION SELECT s.b, r.root FROM reached r JOIN sides s ON r.node = s.a),
        parts AS (SELECT node, min(root) AS component FROM reached GROUP BY node)"""


EMBEDDINGS = f"""
    WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
                         WHERE embedding IS NOT NULL AND len(embedding) > 0
                           AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
                           AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id < y.vec_id AND len(x.e) = len(y.e)
              WHERE list_cosine_similarity(x.e, y.e) >= 0.95), {_components('v', 'l')},
        n AS (SELECT a, count(*) AS n FROM sides GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component, vec_id) AS component_id,
           vec_id = coalesce(component, vec_id) AS kept
    FROM embeddings LEFT JOIN n ON vec_id = a LEFT JOIN parts ON vec_id = node"""

MINHASH = f"""
    WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_LOWER}),
                                '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
                     ELSE list_distinct(list_transform(range(1, len(words) - 1),
                          lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) END AS shingles FROM w),
        x AS (SELECT doc_id, unnest(shingles) AS g FROM s),
        p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM x JOIN x y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
        l AS (SELECT a, b FROM p JOIN s sa ON a = sa.doc_id JOIN s sb ON b = sb.doc_id
              WHERE 100 * n >= 85 * (len(sa.shingles) + len(sb.shingles) - n)), {_components('s', 'l')}
    SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, coalesce(component, doc_id) AS component_id,
           doc_id = coalesce(component, doc_id) AS kept
    FROM s LEFT JOIN parts ON doc_id = node"""


def _fits(rule) -> str:
    return f"((host = '{rule.host}' OR ends_with(host, '.{rule.host}')) AND starts_with(path, '{rule.path}'))"


def _spread(name: str, seed: str, src: str, dst: str, damping: float, steps: int) -> str:
    """CTEs ``<name>0`` to ``<name><steps>``: masses from ``seed`` along the edges, and what could have arrived (room)."""
    out = [f"""{name}_flows AS (SELECT {src} AS src, {dst} AS dst, CAST({damping} AS DOUBLE) * n
                / sum(n) OVER (PARTITION BY {src}) AS part FROM edges)""",
           f"""{name}0 AS (SELECT host, {seed} AS mass, CAST({UNIT} AS BIGINT) AS room FROM seeds WHERE {seed} IS NOT NULL
                UNION ALL SELECT DISTINCT {src}, CAST(0 AS BIGINT), CAST({UNIT} AS BIGINT) FROM edges
                WHERE {src} NOT IN (SELECT {dst} FROM edges) AND {src} NOT IN (SELECT host FROM seeds WHERE {seed} IS NOT NULL))"""]
    for k in range(steps):
        out.append(f"""{name}{k + 1} AS (SELECT host, CAST(sum(mass) AS BIGINT) AS mass, CAST(sum(room) AS BIGINT) AS room FROM (
            SELECT dst AS host, CAST(floor(part * mass) AS BIGINT) AS mass, CAST(floor(part * room) AS BIGINT) AS room
            FROM {name}_flows JOIN {name}{k} ON src = host
            UNION ALL SELECT host, mass, room FROM {name}0) GROUP BY host)""")
    return ",\n        ".join(out)


def url_filters(rules=RULES, damping: float = 0.85, steps: int = 16, block_at: float = 0.5) -> str:
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    rule = " ".join(f"WHEN {_fits(r)} THEN '{r.text}'" for r in ordered)
    allows = " ".join(f"WHEN {_fits(r)} THEN {str(r.allow).lower()}" for r in ordered)
    link = LINK.replace("'", "''")
    host = f"translate(regexp_extract({{}}, '(?s)^.*?://([^/?#]*)', 1), {_LOWER})"
    linked = host.format("CASE WHEN starts_with(l, '//') THEN 'http:' || l ELSE l END")
    return f"""
    WITH h AS (SELECT page_id, html, {host.format("coalesce(url, '')")} AS host,
                      regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
        d AS (SELECT *, CASE {rule} END AS rule, CASE {allows} END AS allows FROM h),
        seeds AS (SELECT host, CASE WHEN count(allows) > 0 THEN
                             CAST(floor(count_if(allows) * CAST({UNIT} AS DOUBLE) / count(*)) AS BIGINT) END AS trust,
                         CASE WHEN count(allows) > 0 THEN
                             CAST(floor(count_if(NOT allows) * CAST({UNIT} AS DOUBLE) / count(*)) AS BIGINT) END AS distrust
                  FROM d GROUP BY host),
        links AS (SELECT host AS src, unnest(list_distinct(list_transform(
                      regexp_extract_all(coalesce(html, ''), '{link}', 1), lambda l: {linked}))) AS dst FROM d),
        edges AS (SELECT src, dst, count(*) AS n FROM links WHERE src <> dst AND src <> '' AND dst <> '' GROUP BY ALL),
        {_spread('t', 'trust', 'src', 'dst', damping, steps)},
        {_spread('b', 'distrust', 'dst', 'src', damping, steps)},
        bad AS (SELECT b{steps}.host FROM b{steps} LEFT JOIN t{steps} ON b{steps}.host = t{steps}.host
                WHERE b{steps}.mass > 0 AND b{steps}.mass / b{steps}.room >= {block_at}
                  AND b{steps}.mass / b{steps}.room > coalesce(t{steps}.mass / t{steps}.room, 0))
    SELECT page_id, host, path, rule,
           CASE WHEN coalesce(allows, host NOT IN (SELECT host FROM bad)) THEN 'allow' ELSE 'block' END AS verdict
    FROM d"""


def centroids(k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: str = "2:") -> str:
    """Plain assignment of every vector to every centroid, the rounds one after the other."""
    parts = [f"""vectors AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {scale}) AS BIGINT)) AS q
  FROM embeddings WHERE len(embedding) = {dims}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND NOT isnan(x) AND abs(CAST(x AS DOUBLE) * {scale}) < {1 << 27})) = {dims}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, q) - 1 AS c, q AS v
  FROM (SELECT sha256('{seed}' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, q FROM vectors ORDER BY h, q LIMIT {k}))"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
  SELECT n, any_value(vec_id) AS vec_id, any_value(q) AS q, min({{'d': d, 'c': c}}) AS nearest FROM (
    SELECT n, vec_id, q, c, list_sum(list_transform(range(1, {dims + 1}), lambda i: (q[i] - v[i]) * (q[i] - v[i]))) AS d
    FROM (SELECT row_number() OVER () AS n, * FROM vectors), c{r}) GROUP BY n)""")
        if r < rounds:
            parts.append(f"""m{r} AS MATERIALIZED (
  SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (
    SELECT nearest.c AS c, i, sum(q[i]) AS s, count(*) AS n FROM a{r}, range(1, {dims + 1}) AS dim(i) GROUP BY 1, 2) GROUP BY c),
c{r + 1} AS MATERIALIZED (SELECT c, coalesce(m{r}.v, c{r}.v) AS v FROM c{r} LEFT JOIN m{r} USING (c))""")
    last = f"a{rounds}"
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(nearest.c AS INTEGER) AS cluster, CAST(nearest.d AS BIGINT) AS distance,
  CAST(sum(nearest.d) OVER (PARTITION BY nearest.c) AS BIGINT) AS cluster_inertia, CAST(sum(nearest.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(v, ',')) AS centroid_sha256
FROM {last} JOIN c{rounds} ON nearest.c = c{rounds}.c"""
