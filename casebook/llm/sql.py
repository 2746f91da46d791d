"""DuckDB SQL of the operators that SQL can express, over the same tables."""

from __future__ import annotations

from casebook.llm import mixing, quality

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def quality_ctes(docs: str = "documents") -> str:
    """CTEs from ``docs`` to ``judged``: every row's counts, base_failed and kept (``rid`` numbers the rows)."""
    n = len(quality.RULES)
    chain = [f"""base AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, * FROM {docs}
), worded AS (
  SELECT rid, coalesce(text, '') AS t, {WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM base
), windows AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS c
  FROM (SELECT rid, unnest(range(1, len(w) - 1)) AS i, unnest(w[1:len(w) - 2]) AS a, unnest(w[2:len(w) - 1]) AS b,
               unnest(w[3:]) AS c FROM worded WHERE len(w) > 2)
), repeats AS (
  SELECT rid, count(DISTINCT i + d) AS r FROM windows, (VALUES (0), (1), (2)) AS s(d) WHERE c > 1 GROUP BY rid
), counts AS (
  SELECT rid, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(t) - length(translate(t, '{quality.SYMBOLS}', '')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, len(l) AS n_lines, coalesce(r, 0) AS n_repeat_words,
         length(t) - length(translate(t, '{quality.CAPITALS}', '')) AS n_capitals,
         length(t) - length(replace(t, '!', '')) AS n_exclaims,
         length(t) - length(replace(t, '.', '')) AS n_stops
  FROM worded LEFT JOIN repeats USING (rid)
), voted AS MATERIALIZED (
  SELECT *, ({quality.BASE_FAILED}) AS base_failed, """ + ", ".join(
        f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END AS v{k}" for k, (_, bad, good) in enumerate(quality.RULES)
    ) + f""" FROM counts
), pat AS MATERIALIZED (
  SELECT {", ".join(f"v{k}" for k in range(n))}, count(*) AS n FROM voted GROUP BY ALL
)"""]
    mark = {-1: "m", 0: "z", 1: "p"}
    start = [f"{quality.BELIEF_PRIOR} AS pr"]
    for k in range(n):
        for v, x in mark.items():
            start += [f"{quality.BELIEF_GOOD[v]} AS g{k}{x}", f"{quality.BELIEF_BAD[v]} AS b{k}{x}"]
    chain.append(f"par0 AS (SELECT {', '.join(start)})")

    def posterior(t: int) -> str:
        odds = " + ".join(
            f"CASE v{k} WHEN 1 THEN ln(g{k}p / b{k}p) WHEN -1 THEN ln(g{k}m / b{k}m) ELSE ln(g{k}z / b{k}z) END"
            for k in range(n))
        return f"1 / (1 + exp(-(ln(pr / (1 - pr)) + {odds})))"

    s = quality.BELIEF_SHARE
    for t in range(1, quality.ROUNDS + 1):
        chain.append(f"post{t} AS MATERIALIZED (SELECT pat.*, {posterior(t)} AS q FROM pat, par{t - 1})")
        cols = [f"(sum(n * q) + {s} * sum(n) * {quality.BELIEF_PRIOR}) / (sum(n) + {s} * sum(n)) AS pr"]
        for k in range(n):
            for v, x in mark.items():
                cols += [
                    f"(sum(CASE WHEN v{k} = {v} THEN n * q ELSE 0 END) + {s} * sum(n) * {quality.BELIEF_GOOD[v]})"
                    f" / (sum(n * q) + {s} * sum(n)) AS g{k}{x}",
                    f"(sum(CASE WHEN v{k} = {v} THEN n * (1 - q) ELSE 0 END) + {s} * sum(n) * {quality.BELIEF_BAD[v]})"
                    f" / (sum(n * (1 - q)) + {s} * sum(n)) AS b{k}{x}",
                ]
        chain.append(f"par{t} AS MATERIALIZED (SELECT {', '.join(cols)} FROM post{t})")
    chain.append(f"""judged AS (
  SELECT base.*, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
         NOT base_failed AND {posterior(0)} >= 0.5 AS kept
  FROM voted JOIN base USING (rid), par{quality.ROUNDS}
)""")
    return ",\n".join(chain)


def op1_quality() -> str:
    return f"""WITH {quality_ctes()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged"""


def mixing_ctes(docs: str = "documents", seed: str = "mix") -> str:
    """CTEs from ``docs`` to ``mixed``: every row with its size, source_size, target, copies and taken."""
    cases = " ".join(f"WHEN {k} THEN {w}" for k, w in enumerate(mixing.WEIGHTS))
    cap, share, m = mixing.CAP, mixing.SHARE, len(mixing.WEIGHTS)
    return f"""sized AS (
  SELECT *, len({WORDS}) AS size FROM {docs}
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {m} {cases} END AS weight
  FROM sized GROUP BY source
), ordered AS (
  SELECT *, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS o,
         coalesce(sum(source_size) OVER b, 0) AS s_before, coalesce(sum(weight) OVER b, 0) AS w_before
  FROM sources WINDOW b AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
  SELECT o, source_size, weight,
         ({share} * (SELECT sum(source_size) FROM sources) - {cap} * s_before)
         / ((SELECT sum(weight) FROM sources) - w_before) AS level
  FROM ordered
), chosen AS (
  SELECT min_by(level, o) AS level FROM levels WHERE {cap}::DOUBLE * source_size >= level * weight
), targets AS (
  SELECT source, source_size, least({cap}::DOUBLE * source_size, level * weight) AS target,
         ('0x' || substr(md5('{seed}' || coalesce('=' || source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM sources, chosen
), ranked AS (
  SELECT sized.*, source_size, target, u,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate,
         row_number() OVER (PARTITION BY sized.source ORDER BY size, doc_id) AS k
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
), mixed AS (
  SELECT *, (floor(u + rate * k) - floor(u + rate * (k - 1)))::BIGINT AS copies FROM ranked
)"""


def op6_mixing() -> str:
    return f"""WITH {mixing_ctes()}
SELECT doc_id, size, source_size, target, copies * size AS taken FROM mixed"""


def op10_topk() -> str:
    return """WITH vecs AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM vecs q JOIN vecs c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY rank <= 5"""


def op11_fill_middle(rate: int = 100, spm: int = 50, seed: int = 7) -> str:
    number = lambda k: f"('0x' || substr(d, {1 + 8 * k}, 8))::BIGINT"
    return f"""WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u,
         sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')) AS d
  FROM documents
), drawn AS (
  SELECT *, len(u) AS n, least({number(0)} % (len(u) + 1), {number(1)} % (len(u) + 1)) AS a,
         greatest({number(0)} % (len(u) + 1), {number(1)} % (len(u) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR {number(2)} % 100 >= {rate} THEN 'plain'
              WHEN {number(3)} % 100 < {spm} THEN 'spm' ELSE 'psm' END AS form
  FROM cut
), parted AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parted"""


def op12_va_clusters(k: int = 16, rounds: int = 3, scale: int = 64, dim: int = 64, seed: int = 1) -> str:
    chain = [f"""vecs AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')), v) - 1)::INTEGER AS cluster, v AS c FROM vecs
  QUALIFY cluster < {k}
)"""]
    for t in range(rounds + 1):
        chain.append(f"""a{t} AS MATERIALIZED (
  SELECT rid, arg_min(cluster, (d, cluster)) AS cluster, min(d)::BIGINT AS distance
  FROM (SELECT rid, cluster, list_dot_product(v, v) - 2 * list_dot_product(v, c) + list_dot_product(c, c) AS d FROM vecs, c{t}) GROUP BY rid
)""")
        if t < rounds:
            chain.append(f"""c{t + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(m.c, c{t}.c) AS c
  FROM c{t} LEFT JOIN (
    SELECT cluster, list(x ORDER BY i) AS c
    FROM (SELECT cluster, i, floor(sum(x) / count(*)) AS x
          FROM (SELECT cluster, unnest(v) AS x, unnest(range({dim})) AS i FROM a{t} JOIN vecs USING (rid)) GROUP BY cluster, i)
    GROUP BY cluster) m USING (cluster)
)""")
    return "WITH " + ",\n".join(chain) + f"""
SELECT vec_id, cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(list_transform(c, lambda x: x::BIGINT::VARCHAR), ',')) AS centroid_sha256
FROM a{rounds} JOIN vecs USING (rid) JOIN c{rounds} USING (cluster)"""
