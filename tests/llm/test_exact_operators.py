"""Packing, byte-level BPE, top-k and the Jaccard join against brute force."""

from __future__ import annotations

import itertools
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ordermill.llm import byte_bpe, codepoints, exact_topk, jaccard_forest, packing
from ordermill.llm.components import connected_components
from tests.llm.tables import documents

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


# --- packing ---


def slow_best_fit(pieces, capacity):
    bins = []
    for at, (length, source, cluster) in enumerate(pieces):
        fits = [
            (capacity - sum(pieces[i][0] for i in members) - length, number) for number, members in enumerate(bins)
            if capacity - sum(pieces[i][0] for i in members) >= length
            and all(source is None or pieces[i][1] != source for i in members)
            and all(cluster is None or pieces[i][2] != cluster for i in members)]
        if fits:
            bins[min(fits)[1]].append(at)
        else:
            bins.append([at])
    return bins


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 20), st.sampled_from([None, "a", "b", "c", "d"]), st.sampled_from([None, 1, 2, 3])), max_size=30))
def test_best_fit_is_the_tightest_compatible(pieces):
    assert packing.best_fit(pieces, 20) == slow_best_fit(pieces, 20)


def check_packing(docs, packed, capacity):
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r["doc_id"]].append((r["text"] or "", r["source"]))
    spans, bins = defaultdict(list), defaultdict(list)
    for r in packed.collect():
        spans[r["doc_id"]].append((r["start"], r["n_chars"]))
        bins[r["bin_id"]].append(r)
    for doc, own in texts.items():
        want = sorted((a, min(capacity, len(t) - a)) for t, _ in own for a in range(0, max(1, len(t)), capacity))
        assert sorted(spans[doc]) == want
    for members in bins.values():
        assert sum(r["n_chars"] for r in members) == members[0]["bin_chars"] <= capacity
        sources = [s for r in members for s in [texts[r["doc_id"]][0][1]] if s is not None]
        assert len(sources) == len(set(sources))
        cut = [texts[r["doc_id"]][0][0] for r in members]
        assert len(cut) == len(set(cut))
        at = 0
        for r in sorted(members, key=lambda r: r["place"]):
            assert r["bin_start"] == at
            at += r["n_chars"]


def test_packing_awkward_rows(spark):
    docs = documents(spark)
    check_packing(docs, packing.pack(docs, capacity=100, group_rows=50), 100)
    assert packing.pack(docs.limit(0)).count() == 0


def test_packing_sample(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check_packing(docs, packing.pack(docs, capacity=2000), 2000)


def test_packing_keeps_near_copies_of_different_sources_apart(spark):
    rows = near_copies(bases=4, copies=12)
    _, group = slow_groups(rows)
    docs = spark.createDataFrame([(i, t, f"s{i}") for i, t in rows], "doc_id bigint, text string, source string")
    packed = packing.pack(docs, capacity=8192)
    check_packing(docs, packed, 8192)
    bins = defaultdict(list)
    for r in packed.collect():
        bins[r["bin_id"]].append(group[r["doc_id"]])
    assert all(len(members) == len(set(members)) for members in bins.values())
    assert len(bins) == max(group.count(g) for g in group)  # and no more bins than that needs


# --- byte-level BPE ---


@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe.Vocabulary.read(RANKS)


@pytest.fixture(scope="module")
def encoding(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def test_hash_is_minimal_and_perfect(vocabulary):
    keys = list(vocabulary.ranks)
    assert sorted(vocabulary.perfect.index.tolist()) == list(range(len(keys)))
    assert all(vocabulary.whole(key) == rank for key, rank in vocabulary.ranks.items())
    assert vocabulary.whole(b"no such token at all") is None


PIECES = ["'", "s", "t", "re", "ve", "ll", " ", "  ", "\n", "\t", "a", "é", "1", "²", "_", "!", "\u3000", "\x1c", "\x85",
          "\xa0", "'s", "\0", "x" * 40, "日本", "😀", "Ⅷ", "ing", "the "]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.lists(st.sampled_from(PIECES), max_size=16).map("".join), st.text(st.characters(exclude_categories=["Cs"]), max_size=12)))
def test_ids_are_those_of_the_library(vocabulary, encoding, text):
    packed = byte_bpe.Encoder(vocabulary).encode([text, "", None])
    assert np.frombuffer(packed[0], "<u4").tolist() == encoding.encode_ordinary(text)
    assert packed[1:] == [b"", b""]
    assert byte_bpe.Decoder(vocabulary).decode(packed[0]) == text.encode()


def test_bpe_columns(spark, encoding):
    for docs in (documents(spark), spark.read.parquet(f"{SF}/documents.parquet")):
        rows = byte_bpe.encode_documents(docs, RANKS).collect()
        assert len(rows) == docs.count()
        for r in rows:
            assert np.frombuffer(r["token_ids"], "<u4").tolist() == encoding.encode_ordinary(r["text"] or "")
            assert r["token_bytes"] == (r["text"] or "").encode()
    assert byte_bpe.encode_documents(docs.limit(0), RANKS).count() == 0


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(codepoints, "span_hashes", lambda codes, starts, ends: np.zeros(len(starts), dtype=np.uint64))
    part = codepoints.block(["ab cd ab", "cd"])
    starts, ends, _ = codepoints.word_spans(part)
    first, kind = codepoints.distinct_spans(part, starts, ends)
    words = [part.text[a:b] for a, b in zip(starts, ends, strict=True)]
    assert [words[first[k]] for k in kind] == words


# --- top-k ---


def slow_topk(rows, k, scale):
    usable = [(i, [int(np.floor(scale * x)) for x in v]) for i, v in rows
              if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    asked = {}
    for i, v in usable:
        if i % 50 == 0:
            asked[i] = min(asked.get(i, v), v)
    out = set()
    for q, v in asked.items():
        found = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in usable if i != q and len(w) == len(v))
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(found[:k], 1)}
    return out


@pytest.mark.parametrize("shard_rows", [16_384, 40])
def test_topk(spark, shard_rows):
    random.seed(1)
    rows = [(i, [float(round(random.gauss(0, 1), 1)) for _ in range(6)]) for i in range(420)]
    rows += [(i, [0.5] * 6) for i in range(500, 800)]  # one vector for many rows
    rows += [(900, None), (950, [float("nan")] * 6), (1000, [None] + [1.0] * 5), (1050, [float("inf")] * 6), (1100, [1.0, 2.0]),
             (1101, [3.0, 4.0]), (None, [1.0] * 6), (50, [9.0] * 6), (61, rows[61][1])]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id bigint, embedding array<double>, shard int, id string")
    got = exact_topk.exact_topk(frame, F.col("vec_id") % 50 == 0, shard_rows=shard_rows, block_rows=5 if shard_rows == 40 else 4096)
    assert {tuple(r) for r in got.collect()} == slow_topk(rows, 5, 256)


def test_topk_without_rows(spark):
    frame = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert exact_topk.exact_topk(frame, F.col("vec_id") % 50 == 0).count() == 0


def test_topk_beyond_doubles(spark):
    rows = [(0, [3e13, 1.0]), (1, [3e13, 1.0]), (2, [3e13, 2.0])]
    got = exact_topk.exact_topk(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), F.col("vec_id") == 0, scale=1, k=2)
    assert {(r["vec_id"], r["rank"]) for r in got.collect()} == {(1, 1), (2, 2)}  # both scores are held at the limit


# --- Jaccard join ---


def slow_groups(rows):
    def shingles(text):
        words = [w for w in (text or "").replace("\n", " ").replace("\t", " ").split(" ") if w]
        return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()

    sets = [shingles(t) for _, t in rows]
    links = [[j for j in range(len(rows)) if j != i and (
        sets[i] == sets[j] or (sets[i] and sets[j] and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])))] for i in range(len(rows))]
    group = list(range(len(rows)))
    for _ in rows:
        group = [min([group[i], *(group[j] for j in links[i])]) for i in range(len(rows))]
    return links, group


def near_copies(seed=3, bases=6, copies=25):
    rng = random.Random(seed)
    rows = []
    for b in range(bases):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(30, 120))]
        for _ in range(copies):
            changed = list(words)
            for _ in range(rng.randrange(0, 4)):
                changed[rng.randrange(len(changed))] = f"x{rng.randrange(99)}"
            rows.append((len(rows), " ".join(changed)))
    return rows


@pytest.mark.parametrize("forest", [jaccard_forest.Forest(), jaccard_forest.Forest(block_rows=7)])
def test_groups_and_links(spark, forest):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in jaccard_forest.similarity_groups(docs, forest).collect()}
    links, group = slow_groups(rows)
    assert {i: got[i]["n_links"] for i in got} == {i: len(links[i]) for i in range(len(rows))}
    assert {i: got[i]["class_id"] for i in got} == dict(enumerate(group))
    kept = jaccard_forest.keep_one_per_group(docs, forest)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(group))


def test_groups_of_awkward_rows(spark):
    docs = documents(spark)
    got = jaccard_forest.similarity_groups(docs).collect()
    assert len(got) == 12
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["class_id"] == by_id[2]["class_id"] == by_id[3]["class_id"] == 1 and by_id[1]["n_links"] == 2
    assert by_id[4]["class_id"] == by_id[5]["class_id"] == by_id[6]["class_id"] == 4 and by_id[4]["n_links"] == 3
    assert by_id[7]["n_links"] == by_id[8]["n_links"] == by_id[None]["n_links"] == 0
    kept = jaccard_forest.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(x) for x in (1, 4, 7, 8, 9, 10, None))
    assert jaccard_forest.keep_one_per_group(docs.limit(0)).count() == 0


def test_kept_rows_have_all_columns_whatever_their_names(spark):
    docs = documents(spark).withColumns({name: F.lit(name) for name in ("_own_hash", "_OWN_HASH_", "_id", "_hash", "_rows")})
    kept = jaccard_forest.keep_one_per_group(docs)
    assert kept.columns == docs.columns and kept.count() == 7
    assert kept.filter("_own_hash <> '_own_hash' OR _OWN_HASH_ <> '_OWN_HASH_' OR _id <> '_id'").count() == 0


def test_prefix_is_shortened_to_the_target():
    forest = jaccard_forest.Forest()
    depth = forest.prefix()
    assert 1 - (1 - 0.8**depth) ** forest.trees >= forest.recall > 1 - (1 - 0.8 ** (depth + 1)) ** forest.trees


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_shingle_sets_hash_each_word_as_it_stands(monkeypatch):
    """Equal words have equal hashes, so words need not be told apart by kind first; that took most of the time."""
    def refuse(*_):
        raise AssertionError("words are told apart")

    monkeypatch.setattr(jaccard_forest.cp, "distinct_spans", refuse)
    texts = ["a b c d e a b c d e a b", "a b c d e", "b c d e a", "a b", "a  b", "", None, "é b c d e " * 3]
    sets = jaccard_forest.shingle_sets(texts, 5)

    def plain(text):
        words = (text or "").split()
        return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1 if words else 0))}

    assert [len(s) for s in sets] == [len(plain(t)) for t in texts]
    assert all((s[1:] > s[:-1]).all() for s in sets)
    for (one, x), (other, y) in itertools.combinations(zip(texts, sets, strict=True), 2):
        assert len(np.intersect1d(x, y)) == len(plain(one) & plain(other))
