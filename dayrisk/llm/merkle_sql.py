"""SQL for DuckDB of the Merkle query: the trees level by level, without intervals."""

from __future__ import annotations

from dayrisk.llm.merkle import FAN, FIELDS

#: Levels that the SQL has: groups of up to 3 ** 15 rows, 3 ** 8 groups.
LEAF_LEVELS, GROUP_LEVELS = 15, 8


def _digest(text: str = "text") -> str:
    framed = [f"coalesce(strlen(CAST({text if c == 'text' else c} AS VARCHAR)) || ':' || CAST({text if c == 'text' else c} AS VARCHAR), '-')" for c in FIELDS]
    return f"sha256({' || '.join(framed)})"


CRC = """
crc_step AS (SELECT list(c ORDER BY i) AS steps FROM (
  SELECT i, list_reduce(list_prepend(i, [1::BIGINT, 1, 1, 1, 1, 1, 1, 1]), lambda a, x: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM range(256) r(i)))"""
ODD_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
  lambda a, x: xor(a >> 8, steps[(xor(a, x) & 255) + 1])), 4294967295) % 2"""


def _levels(name: str, keys: str, depth: int) -> list[str]:
    """CTEs ``name0`` .. with (keys, r, n, digest, lft, rgt, many); ``name0`` must be there up to its siblings, as ``name0_rows``."""
    part, out = (f"PARTITION BY {keys + ', ' if keys else ''}r // {FAN} ORDER BY r", [])
    head = f"{keys}, " if keys else ""
    for k in range(depth + 1):
        if k:
            out.append(
                f"{name}{k}_rows AS (SELECT {head}r // {FAN} AS r, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(digest, '' ORDER BY r)) ELSE any_value(digest) END AS digest, "
                f"(any_value(n) + {FAN - 1}) // {FAN} AS n FROM {name}{k - 1} GROUP BY {head}r // {FAN})"
            )
        out.append(
            f"{name}{k} AS (SELECT *, n > 1 AS many, coalesce(string_agg(digest, '') OVER ({part} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft, "
            f"coalesce(string_agg(digest, '') OVER ({part} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt FROM {name}{k}_rows)"
        )
    return out


def check_documents_sql() -> str:
    ctes = [
        CRC,
        f"d AS (SELECT doc_id, coalesce('=' || source, '') AS src, {_digest()} AS digest, "
        f"CASE WHEN {ODD_CRC} = 0 THEN {_digest("replace(text, chr(10), '')")} END AS claim FROM documents, crc_step)",
        "t0_rows AS (SELECT src, row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, digest) - 1 AS r, digest, count(*) OVER (PARTITION BY src) AS n, doc_id, coalesce(claim, digest) AS claim FROM d)",
        *_levels("t", "src", LEAF_LEVELS),
        f"g0_rows AS (SELECT row_number() OVER (ORDER BY src) - 1 AS r, digest, count(*) OVER () AS n, src FROM t{LEAF_LEVELS})",
        *_levels("g", "", GROUP_LEVELS),
        "f0 AS (SELECT doc_id, src, r, digest AS leaf, CASE WHEN many THEN sha256(lft || claim || rgt) ELSE claim END AS fold, lft || rgt AS proof FROM t0)",
    ]
    for k in range(1, LEAF_LEVELS + 1):
        ctes.append(
            f"f{k} AS (SELECT doc_id, f.src, f.r // {FAN} AS r, leaf, CASE WHEN many THEN sha256(lft || fold || rgt) ELSE fold END AS fold, proof || lft || rgt AS proof "
            f"FROM f{k - 1} f JOIN t{k} t ON f.src = t.src AND f.r // {FAN} = t.r)"
        )
    ctes.append(
        f"h0 AS (SELECT doc_id, leaf, f.src, g.digest AS subroot, g.r, CASE WHEN many THEN sha256(lft || fold || rgt) ELSE fold END AS fold, proof || lft || rgt AS proof "
        f"FROM f{LEAF_LEVELS} f JOIN g0 g ON f.src = g.src)"
    )
    for k in range(1, GROUP_LEVELS + 1):
        ctes.append(
            f"h{k} AS (SELECT doc_id, leaf, subroot, h.r // {FAN} AS r, CASE WHEN many THEN sha256(lft || fold || rgt) ELSE fold END AS fold, proof || lft || rgt AS proof "
            f"FROM h{k - 1} h JOIN g{k} g ON h.r // {FAN} = g.r)"
        )
    return (
        "WITH " + ",\n".join(ctes) + f"\nSELECT doc_id, leaf, subroot, (SELECT digest FROM g{GROUP_LEVELS}) AS root, sha256(proof) AS proof_sha256, fold AS folded_root, "
        f"fold = (SELECT digest FROM g{GROUP_LEVELS}) AS verified FROM h{GROUP_LEVELS}"
    )
