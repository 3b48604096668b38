"""The codes of `embeddings` as SQL of DuckDB: every distance of every round, without bounds."""

from __future__ import annotations

from sluice.llm.vector_codes import ENTRIES, PARTS, ROUNDS, SCALE


def codes_sql() -> str:
    tables = [
        f"""kept AS (SELECT row_number() OVER () AS rid, vec_id, label,
          list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""parts AS (SELECT rid, p, v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] AS x
          FROM kept, (SELECT unnest(range({PARTS})) AS p))""",
        f"""b0 AS (SELECT p, e, x FROM parts JOIN (SELECT rid, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS e FROM kept)
          USING (rid) WHERE e < {ENTRIES})""",
    ]
    for k in range(ROUNDS + 1):
        tables.append(
            f"""a{k} AS (SELECT rid, p, min(d) AS d, arg_min(e, d * {ENTRIES} + e) AS e FROM (
              SELECT rid, a.p, e, list_sum(list_transform(list_zip(a.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
              FROM parts a JOIN b{k} b ON a.p = b.p) GROUP BY rid, p)"""
        )
        tables.append(
            f"""b{k + 1} AS (SELECT p, e, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN (
              SELECT p, e, list(floor(total::DOUBLE / n)::BIGINT ORDER BY i) AS x FROM (
                SELECT p, e, i, sum(y)::BIGINT AS total, count(*) AS n FROM (
                  SELECT p, e, unnest(x) AS y, unnest(range(len(x))) AS i FROM parts JOIN a{k} USING (rid, p)) GROUP BY p, e, i)
              GROUP BY p, e) m USING (p, e))"""
        )
    return (
        "WITH " + ",\n".join(tables[:-1]) + f""",
        coded AS (SELECT rid, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{ROUNDS} GROUP BY rid)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, (SELECT sha256(string_agg(
            array_to_string(x, ','), ',' ORDER BY p, e)) FROM b{ROUNDS}) AS codebooks_sha256
        FROM kept JOIN coded USING (rid)"""
    )
