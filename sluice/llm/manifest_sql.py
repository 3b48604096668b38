"""The Merkle manifest of `documents` as SQL of DuckDB, for groups of up to 16**5 rows and as many groups."""

from __future__ import annotations

DEPTH = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _leaf(text: str) -> str:
    parts = [
        f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({v}::VARCHAR) || ':' || {v}::VARCHAR END"
        for c in FIELDS
        for v in [text if c == "text" else c]
    ]
    return f"sha256({' || '.join(parts)})"


# crc32 of the decimal id: bytes folded in one at a time, bit by bit, with the reversed polynomial
_BITS = "list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, (x & 1) * 3988292384))"
_BYTES = "list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)"
_CRC = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {_BYTES}), lambda c, b: {_BITS}), 4294967295::BIGINT)"


def _tree(name: str) -> list[str]:
    """CTEs `<name>1` .. from `<name>0` (g, idx, n, h), and siblings `<name>s0` .. of every level. A group
    of one node stays as it is."""
    out = []
    for k in range(DEPTH):
        run = "PARTITION BY g, idx // 16 ORDER BY idx ROWS BETWEEN"
        out.append(
            f"""{name}s{k} AS (SELECT g, idx, n,
              coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
              coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})"""
        )
        out.append(
            f"""{name}{k + 1} AS (SELECT g, idx // 16 AS idx, (any_value(n) + 15) // 16 AS n,
              CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY idx)) ELSE any_value(h) END AS h
              FROM {name}{k} GROUP BY g, idx // 16)"""
        )
    return out


def _climb(name: str, at: str, fold: str, proof: str) -> tuple[str, str, str]:
    """Joins, the folded hash and the text of the siblings of a row `at` (g, idx) on its way up."""
    joins = []
    for k in range(DEPTH):
        s = f"{name}s{k}"
        joins.append(f"JOIN {s} ON {s}.g = {at}.g AND {s}.idx = {at}.idx // {16**k}")
        fold = f"CASE WHEN {s}.n > 1 THEN sha256({s}.l || ({fold}) || {s}.r) ELSE ({fold}) END"
        proof = f"{proof} || {s}.l || {s}.r"
    return " ".join(joins), fold, proof


def manifest_sql() -> str:
    up, fold, proof = _climb("d", "a", "f0", "''")
    top, fold2, proof2 = _climb("t", "b", "f1", "p1")
    tables = [
        f"""leaves AS (SELECT doc_id, coalesce('=' || source, '') AS g, {_leaf('text')} AS h,
          CASE WHEN coalesce({_CRC} % 5 = 0, false) THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS other FROM documents)""",
        """a AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS idx,
          count(*) OVER (PARTITION BY g) AS n FROM leaves)""",
        "d0 AS (SELECT g, idx, n, h FROM a)", *_tree("d"),
        f"""t0 AS (SELECT '' AS g, row_number() OVER (ORDER BY d{DEPTH}.g) - 1 AS idx, count(*) OVER () AS n, h, d{DEPTH}.g AS name
          FROM d{DEPTH})""",
        *_tree("t"),
        f"inner1 AS (SELECT a.*, f0, {fold} AS f1, {proof} AS p1 FROM (SELECT *, coalesce(other, h) AS f0 FROM a) a {up})",
    ]
    body = f"""SELECT doc_id, h AS leaf, subroot, root, sha256(p2) AS proof_sha256, f2 AS folded_root, f2 = root AS verified
      FROM (SELECT b.*, {fold2} AS f2, {proof2} AS p2
            FROM (SELECT i.doc_id, i.h, i.f1, i.p1, t0.g, t0.idx, t0.h AS subroot, (SELECT h FROM t{DEPTH}) AS root
                  FROM inner1 i JOIN t0 ON t0.name = i.g) b {top})"""
    return "WITH " + ",\n".join(tables) + "\n" + body
