"""Near-duplicate vectors, conversation repair and the Merkle manifest against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checks.compare import _comparable, connect
from ordermill.llm import lattice_neardup, merkle_manifest, structure_queries, turn_repair
from ordermill.llm.positions import positioned
from tests.llm.tables import documents

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(structure_queries.QUERIES))
def test_queries_against_sql(spark, name):
    got = structure_queries.QUERIES[name](spark, SF).toPandas()
    want = connect(SF).execute(structure_queries.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _comparable(got) == _comparable(want)


def test_positions_of_equal_rows_and_null_groups(spark):
    rows = [("a", 1)] * 500 + [("a", None), ("a", 7), (None, 2), (None, 1), ("b", 3)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(7)
    got = defaultdict(list)
    for r in positioned(df, ["g"], ["v"], "pos", "test-positions").collect():
        got[r["g"]].append((r["pos"], r["v"]))
    assert sorted(got["a"], key=lambda x: x[0]) == list(enumerate([None] + [1] * 500 + [7]))
    assert sorted(got[None]) == [(0, 1), (1, 2)] and got["b"] == [(0, 3)]


# --- near-duplicate vectors ---


def test_e8_decoding_is_nearest():
    random_points = np.random.default_rng(1).normal(size=(200, 8)) * 2
    found = lattice_neardup.nearest_e8(random_points)
    twice = 2 * found
    assert (twice == np.rint(twice)).all() and (found.sum(1) % 2 == 0).all()
    parity = twice.astype(int) % 2
    assert (parity == parity[:, :1]).all()
    # No lattice point one shortest step away is nearer.
    own = ((random_points - found) ** 2).sum(1)
    around = ((random_points[:, None] - found[:, None] - lattice_neardup.STEPS[None, 1:]) ** 2).sum(2)
    assert (own[:, None] <= around + 1e-9).all()
    assert len(lattice_neardup.STEPS) == 241 and np.allclose((lattice_neardup.STEPS[1:] ** 2).sum(1), 2)


def test_cells_do_not_depend_on_the_batch():
    vectors = np.random.default_rng(2).normal(size=(300, 64))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    shape = lattice_neardup.Lattice.fit(1000, 0.95, 0.995)
    whole = shape.keys(vectors)
    parts = np.concatenate([shape.keys(vectors[i:i + 7]) for i in range(0, 300, 7)])
    assert (whole == parts).all()


def test_recall_at_the_threshold():
    """Pairs with a cosine of exactly 0.95 meet about as often as planned."""
    random_ = np.random.default_rng(3)
    one = random_.normal(size=(1500, 48))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    other = random_.normal(size=one.shape)
    other -= (other * one).sum(1, keepdims=True) * one
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    pair = 0.95 * one + np.sqrt(1 - 0.95**2) * other
    shape = lattice_neardup.Lattice.fit(10_000, 0.95, 0.995)
    a, b = shape.keys(one), shape.keys(pair)
    met = (a == b[:, :, :1]).any((1, 2)) | (b == a[:, :, :1]).any((1, 2))
    assert met.mean() >= 0.98


def slow_links(rows, threshold=0.95):
    good = [(i, v) for i, (d, v) in enumerate(rows) if d is not None and v and all(
        x is not None and np.isfinite(x) for x in v) and any(v)]
    links, root = defaultdict(set), {i: i for i in range(len(rows))}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, v) in enumerate(good):
        for j, w in good[:n]:
            if len(v) == len(w):
                a, b = (np.array(x, float) / max(map(abs, x)) for x in (v, w))  # squares of 1e300 are no doubles
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    links[i].add(j)
                    links[j].add(i)
                    root[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    out = []
    for i, (d, _) in enumerate(rows):
        component = None if d is None else min(x for x in members[find(i)] if x is not None)
        out.append((d, len(links[i]), component, d == component))
    return sorted(out, key=str)


def near_rows(seed=4):
    """Clumps, chains, copies, hostile vectors."""
    random_ = np.random.default_rng(seed)
    rows, number = [], 0
    for size in (1, 1, 2, 5, 40):
        centre = random_.normal(size=16)
        for _ in range(size):
            rows.append((number, (centre + 0.1 * random_.normal(size=16)).tolist()))
            number += 1
    angle = 0.25  # a chain: neighbours link, others don't
    for k in range(8):
        v = [0.0] * 16
        v[0], v[1] = float(np.cos(k * angle)), float(np.sin(k * angle))
        rows.append((100 + k, v))
    rows += [(200 + k, rows[0][1]) for k in range(30)] + [(250, [2 * x for x in rows[0][1]])]
    nan, inf = float("nan"), float("inf")
    rows += [(300, None), (301, []), (302, [0.0] * 16), (303, [nan] * 16), (304, [inf] + [1.0] * 15), (305, [None] + [1.0] * 15),
             (None, rows[0][1]), (306, [1.0, 2.0]), (307, [1.0, 2.0]), (307, [1.0, 2.0]), (308, [1e-300] * 3), (309, [1e300] * 3)]
    return rows


def test_links_against_all_pairs(spark):
    rows = near_rows()
    df = spark.createDataFrame(
        [r + (1, 2, "x") for r in rows], "vec_id bigint, embedding array<double>, node int, key int, copy_1 string").repartition(3)
    got = sorted((tuple(r) for r in lattice_neardup.near_duplicates(df, recall=0.9999).collect()), key=str)
    assert got == slow_links(rows)
    assert lattice_neardup.near_duplicates(df.limit(0)).count() == 0


def test_a_large_cell_is_compared_in_blocks(spark, monkeypatch):
    rows = near_rows(5)
    monkeypatch.setattr(lattice_neardup, "BLOCK_ROWS", 4)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted((tuple(r) for r in lattice_neardup.near_duplicates(df, recall=0.9999).collect()), key=str)
    assert got == slow_links(rows)


# --- conversation repair ---

WHITE = " \t\n\x0b\x0c\r"
AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
WANTED = {0: "u", 1: "u", 2: "a", 3: "u"}
NAMES = {"u": "user", "a": "assistant"}


def slow_repair(rows):
    """Every way to the end from each state with its letters and rows, the least kept."""
    seen, faults = set(), []
    for _, role, text in rows:
        said = text.strip(WHITE)
        faults.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))

    def inserted(ways):
        for _ in range(4):
            for p in range(4):
                rest = ways[AFTER[p, WANTED[p]]]
                if rest:
                    way = (rest[0] + 3, "I" + rest[1], ((NAMES[WANTED[p]], ""),) + rest[2])
                    if not ways[p] or way[:2] < ways[p][:2]:
                        ways[p] = way
        return ways

    ways = inserted([(0, "", ()), None, None, (0, "", ())])
    for (_, role, text), fault in zip(rows[::-1], faults[::-1], strict=True):
        fresh, more = [], 3 if fault == "truncated" else 0
        for p in range(4):
            choices = [(4 + ways[p][0], "D" + ways[p][1], ways[p][2])]
            if fault not in ("blank", "duplicate"):
                kept, new = ways[AFTER[p, role[:1]]] if (p, role[:1]) in AFTER else None, ways[AFTER[p, WANTED[p]]]
                choices += [(more + kept[0], "K" + kept[1], ((role, text),) + kept[2])] if kept else []
                choices.append((3 + more + new[0], "R" + new[1], ((NAMES[WANTED[p]], text),) + new[2]))
            fresh.append(min(choices, key=lambda w: w[:2]))
        ways = inserted(fresh)
    cost, audit, kept = ways[0]
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
        faults.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest())


def slow_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        what = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if what:
            text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
            out += [(turn, "user" if what == 4 else role, text)] * (2 if what == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


ROW = st.tuples(st.sampled_from("suaot"), st.sampled_from(["", "w", "w.", "v.", "v! ", "y?\n"]))


@settings(max_examples=400, deadline=None)
@given(st.lists(ROW, max_size=14))
def test_block_tables_against_all_ways(rows):
    rows = [(i, {"s": "system", "u": "user", "a": "assistant", "o": "other", "t": "tool"}[r], t) for i, (r, t) in enumerate(rows)]
    want, seen, codes = slow_repair(rows), set(), ""
    for _, role, text in rows:
        said = text.strip(WHITE)
        fault = 1 if not said else 2 if (role, text) in seen else 3 if said[-1] not in ".!?" else 0
        seen.add((role, text))
        codes += chr(turn_repair.FIRST_CODE + 4 * ("sua".index(role[0]) if role[0] in "sua" else 3) + fault)
    assert turn_repair.judged(codes) == want[1:7]
    digest = turn_repair.Repaired(want[6])
    for _, role, text in rows:
        digest.row(role, text)
    assert digest.hexdigest() == want[7]


def test_blocks_are_looked_up_and_few_vectors_exist():
    tables = turn_repair.tables()
    assert tables.block.shape == (len(tables.vectors), len(turn_repair.SYMBOLS) ** turn_repair.BLOCK)
    assert len(tables.vectors) < 200
    symbols = np.array([random.Random(1).randrange(9) for _ in range(5000)])
    cost, audit = tables.repair(symbols)
    assert len(audit) - audit.count("I") == 5000
    at, slow = turn_repair.AT_END, 0
    for symbol in symbols[::-1]:
        at = turn_repair.cost_before(turn_repair.SYMBOLS[symbol], at)
    assert cost == at[0]


def test_repair_of_awkward_conversations(spark):
    random_ = random.Random(6)
    words = [None, "", " \n", "done.", "cut off", "so?  ", "done.", "é 😀!", "x" * 50_000 + "."]
    roles = [None, "", "system", "user", "assistant", "assistant", "user", "tool"]
    rows = [(conv, random_.choice([None, 0, 1, 2, 3, 4, 5, 9]), random_.choice(roles), random_.choice(words))
            for conv in [None, *range(40)] for _ in range(random_.randrange(1, 12))]
    rows += [(99, t, "user", "same.") for t in range(300)]
    rows += [(c, t, "user", "gone.") for c in range(2000, 2200) for t in [1] if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    df = spark.createDataFrame(
        [r + (1, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, pos int, codes string").repartition(5)
    got = {r[0]: tuple(r[1:]) for r in turn_repair.repair(df).collect()}
    by_conv = defaultdict(list)
    for r in rows:
        by_conv[r[0]].append(r)
    assert got == {conv: slow_repair(slow_damage(own)) for conv, own in by_conv.items()}
    gone = next(c for c in by_conv if c and c >= 2000)
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert turn_repair.repair(df.limit(0)).count() == 0


def test_long_conversation_in_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(turn_repair, "CHUNK_ROWS", 7)
    rows = [(1, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(500)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(4)
    assert tuple(turn_repair.repair(df).first())[1:] == slow_repair(slow_damage(rows))


# --- Merkle manifest ---


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def slow_manifest(rows):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, text):
        return h("".join(map(field, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text))))

    def levels(nodes):
        found = [nodes]
        while len(found[-1]) > 1:
            found.append([h("".join(found[-1][i:i + 8])) for i in range(0, len(found[-1]), 8)])
        return found

    def path(tree, at):
        for nodes in tree[:-1]:
            start = at // 8 * 8
            yield "".join(nodes[start:at]), "".join(nodes[at + 1:start + 8])
            at //= 8

    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda x: x[:3])
        trees[lang] = levels([x[2] for x in by_lang[lang]])
    top = levels([trees[lang][-1][0] for lang in langs])
    out = []
    for place, lang in enumerate(langs):
        for at, (_, _, own, r) in enumerate(by_lang[lang]):
            text, steps = r["text"], [*path(trees[lang], at), *path(top, place)]
            if r["doc_id"] is not None and text is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = leaf(r, text)
            for left, right in steps:
                node = h(left + node + right)
            root = top[-1][0]
            out.append((r["doc_id"], own, trees[lang][-1][0], root, h("".join(a + b for a, b in steps)), node, node == root))
    return sorted(out, key=str)


def manifest(df):
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    found = merkle_manifest.manifest(df, third, F.translate("text", structure_queries.UPPER, structure_queries.LOWER))
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("sizes", [(1,), (8, 9, 1, 64), (65, 513, 2), (4097, 1, 1, 1, 1, 1, 1, 1, 1, 1)])
def test_manifest_of_many_sizes(spark, sizes):
    rows = [(i * 10 + k, f"Text {i}", None if k == 0 else f"l{k}", "s", i) for k, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(6)
    assert manifest(df) == slow_manifest(df.collect())


def test_manifest_of_awkward_rows(spark):
    df = documents(spark)
    assert manifest(df) == slow_manifest(df.collect())
    assert manifest(df.limit(0)) == []
    assert manifest(df.repartition(5)) == manifest(df)


def test_only_every_third_level_is_stored(spark):
    leaves = spark.range(1000).select(F.lit("t").alias("tree"), F.col("id").alias("pos"), F.sha2(F.col("id").cast("string"), 256).alias("hash"))
    forest = merkle_manifest.build(leaves, "test-forest")
    assert [level.count() for level in forest.stored] == [1000, 2, 1]
    assert forest.paths().select(F.size("path").alias("n")).distinct().first()["n"] == 4
