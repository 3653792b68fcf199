"""Near-duplicate vectors, conversation repair and the Merkle manifest as registered queries, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import lattice_neardup, merkle_manifest, turn_repair

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op11_lattice_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return lattice_neardup.near_duplicates(spark.read.parquet(f"{folder}/embeddings.parquet"))


OP11_SQL = """
WITH RECURSIVE v AS (
    SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS x, coalesce(
        vec_id IS NOT NULL AND len(embedding) > 0
        AND NOT list_contains(list_transform(embedding, lambda e: coalesce(isfinite(e), false)), false)
        AND list_contains(list_transform(embedding, lambda e: e <> 0), true), false) AS part
    FROM embeddings),
links AS (
    SELECT a.r AS a, b.r AS b, b.vec_id FROM v AS a JOIN v AS b ON a.r <> b.r AND len(a.x) = len(b.x)
    WHERE a.part AND b.part AND list_cosine_similarity(a.x, b.x) >= 0.95),
reach AS (
    SELECT r AS a, r AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
named AS (SELECT reach.a AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY 1),
counted AS (SELECT a AS r, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN named USING (r) LEFT JOIN counted USING (r)
"""


def sql_crc32(text: str) -> str:
    """CRC-32 of an ASCII text: reflected, with the polynomial 0xEDB88320."""
    bits = "list_prepend(xor(c, b), list_transform(range(8), lambda z: z::UBIGINT))"
    bytes_ = f"list_transform(range(1, length({text}) + 1), lambda nth: ascii(({text})[nth])::UBIGINT)"
    return (f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {bytes_}), lambda c, b: list_reduce({bits}, "
            "lambda y, z: xor(y >> 1, 3988292384::UBIGINT * (y & 1)))), 4294967295::UBIGINT)")


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return turn_repair.repair(spark.read.parquet(f"{folder}/conversations.parquet"))


def _edited(best: str, cost: str, letter: str, row: str = "''") -> str:
    """A way to the end (cost in 9 digits, letters, chr(1), rows) with one edit more in front."""
    return (f"lpad((left({best}, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || '{letter}' "
            f"|| substr({best}, 10, strpos({best}, chr(1)) - 10) || chr(1) || {row} || substr({best}, strpos({best}, chr(1)) + 1)")


def _at_row(state: int) -> str:
    """The least way from a state before a row, without an insertion."""
    after = {0: 2, 1: 2, 2: 3, 3: 2}[state]
    said = {2: "user", 3: "assistant"}[after]
    kept = "".join(f"WHEN left(role, 1) = '{role}' THEN {_edited(f'x{to}', 'more', 'K', 'own')} " for role, to in {
        0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[state].items())
    renamed = _edited(f"x{after}", "3 + more", "R", f"'{said}:' || text || chr(10)")
    return (f"least({_edited(f'x{state}', '4', 'D')}, CASE WHEN fault < 2 THEN {renamed} END, "
            f"CASE WHEN fault < 2 THEN CASE {kept} END END)")


OP12_SQL = rf"""
WITH RECURSIVE c AS (
    SELECT row_number() OVER () AS r, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
m AS (SELECT *, {sql_crc32('k')} % 20 AS what FROM c),
d AS (
    SELECT conv_id, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role,
           CASE what WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, r, copy
    FROM m, range(2) AS s(copy) WHERE what <> 0 AND (copy = 0 OR what = 3)),
o AS (
    SELECT *, row_number() OVER w AS i, lag(left(role, 1)) OVER w || left(role, 1) AS pair,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, r, copy) AS again,
           regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS ending
    FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, r, copy)),
f AS (
    SELECT *, CASE WHEN ending = '' THEN 3 WHEN again > 1 THEN 2 WHEN ending NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS fault,
           role || ':' || text || chr(10) AS own FROM o),
g AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 3) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 1) AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY 1),
way(conv_id, i, x0, x1, x2, x3) AS (
    SELECT conv_id, n, '000000000' || chr(1), '000000006II' || chr(1) || 'user:' || chr(10) || 'assistant:' || chr(10),
           '000000003I' || chr(1) || 'assistant:' || chr(10), '000000000' || chr(1) FROM g
    UNION ALL
    SELECT conv_id, i, least(b0, {_edited('x2', '3', 'I', "'user:' || chr(10)")}), least(b1, {_edited('x2', '3', 'I', "'user:' || chr(10)")}),
           x2, least(b3, {_edited('b2', '3', 'I', "'user:' || chr(10)")})
    FROM (SELECT *, least(b2, {_edited('b3', '3', 'I', "'assistant:' || chr(10)")}) AS x2 FROM (
        SELECT way.conv_id, way.i - 1 AS i, {_at_row(0)} AS b0, {_at_row(1)} AS b1, {_at_row(2)} AS b2, {_at_row(3)} AS b3
        FROM (SELECT * FROM way) AS way JOIN (SELECT *, CASE WHEN fault = 1 THEN 3 ELSE 0 END AS more FROM f) AS f
          ON way.conv_id IS NOT DISTINCT FROM f.conv_id AND way.i = f.i))),
best AS (SELECT conv_id, x0, strpos(x0, chr(1)) AS cut FROM way WHERE i = 0)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(left(x0, 9)::BIGINT, 0) AS cost,
       coalesce(substr(x0, 10, cut - 10), '') AS audit,
       sha256(coalesce(left(substr(x0, cut + 1), greatest(length(x0) - cut - 1, 0)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS e
LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM e.conv_id
"""


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return merkle_manifest.manifest(docs, third, F.translate("text", UPPER, LOWER))


#: Levels of the SQL: up to 8 ** 8 documents of a language, 8 ** 3 languages.
TREE_LEVELS, TOP_LEVELS = 8, 3


def _levels(prefix: str, number: int) -> str:
    """Nodes of each level with what stands left and right of them in their run; a tree of one node stays as it is."""
    run = "PARTITION BY tree, pos // 8 ORDER BY pos ROWS BETWEEN"
    return ",\n".join(f"""{prefix}{n}s AS (
    SELECT tree, pos, hash, count(*) OVER (PARTITION BY tree) = 1 AS one,
           coalesce(string_agg(hash, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
           coalesce(string_agg(hash, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {prefix}{n}),
{prefix}{n + 1} AS (
    SELECT tree, pos // 8 AS pos, CASE WHEN bool_and(one) THEN min(hash) ELSE sha256(string_agg(hash, '' ORDER BY pos)) END AS hash
    FROM {prefix}{n}s GROUP BY ALL)""" for n in range(number))


def _fold(start: str, names: list[str]) -> str:
    for name in names:
        start = f"CASE WHEN {name}.one THEN {start} ELSE sha256({name}.l || {start} || {name}.r) END"
    return start


def _sql_leaf(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f})::VARCHAR || ':' || {f}, '-')" for f in fields) + ")"


_STEPS = [f"a{n}s" for n in range(TREE_LEVELS)] + [f"b{n}s" for n in range(TOP_LEVELS)]


def _fold_steps() -> str:
    """One step of the fold per line, so that no expression holds another twice over."""
    lines, before = [], "claimed"
    for n, name in enumerate(_STEPS):
        lines.append(f"h{n} AS (SELECT *, {_fold(before, [f'p.{name}']).replace(f'p.{name}.', f'{name}_')} AS f{n} FROM {'p' if n == 0 else f'h{n - 1}'})")
        before = f"f{n}"
    return ",\n".join(lines)


OP13_SQL = f"""
WITH d AS (
    SELECT doc_id, lang, {_sql_leaf('text')} AS leaf, CASE WHEN {sql_crc32('doc_id::VARCHAR')} % 3 = 0
           THEN {_sql_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {_sql_leaf('text')} END AS claimed FROM documents),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1 AS pos FROM d),
a0 AS (SELECT lang AS tree, pos, leaf AS hash FROM leaves),
{_levels('a', TREE_LEVELS)},
subroots AS (
    SELECT tree AS lang, row_number() OVER (ORDER BY encode(tree) NULLS FIRST) - 1 AS place, hash FROM a{TREE_LEVELS}),
b0 AS (SELECT 0 AS tree, place AS pos, hash FROM subroots),
{_levels('b', TOP_LEVELS)},
p AS (
    SELECT leaves.*, subroots.hash AS subroot, b{TOP_LEVELS}.hash AS root,
           {', '.join(f'{s}.one AS {s}_one, {s}.l AS {s}_l, {s}.r AS {s}_r' for s in _STEPS)}
    FROM leaves JOIN subroots ON subroots.lang IS NOT DISTINCT FROM leaves.lang CROSS JOIN b{TOP_LEVELS}
    {' '.join(f'JOIN a{n}s ON a{n}s.tree IS NOT DISTINCT FROM leaves.lang AND a{n}s.pos = leaves.pos // {8**n}' for n in range(TREE_LEVELS))}
    {' '.join(f'JOIN b{n}s ON b{n}s.pos = place // {8**n}' for n in range(TOP_LEVELS))}),
{_fold_steps()}
SELECT doc_id, leaf, subroot, root, sha256({' || '.join(f'{s}_l || {s}_r' for s in _STEPS)}) AS proof_sha256,
       f{len(_STEPS) - 1} AS folded_root, f{len(_STEPS) - 1} = root AS verified
FROM h{len(_STEPS) - 1}
"""

QUERIES = {
    "op11_lattice_near_duplicates": op11_lattice_near_duplicates,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_merkle_manifest": op13_merkle_manifest,
}

SQL = {
    "op11_lattice_near_duplicates": OP11_SQL, "op12_conversation_repair": OP12_SQL, "op13_merkle_manifest": OP13_SQL,
}
