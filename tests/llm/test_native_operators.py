"""Quality rules, chat formatting and URL filters: against SQL, and on hand-made rows."""

from __future__ import annotations

import hashlib

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__
from checks.compare import _comparable, connect
from ordermill.llm import chat_format, quality_rules, url_filter
from ordermill.llm.queries import SQL, URL_RULES
from tests.llm.tables import documents

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, name):
    got = __spark_entry__.queries()[name](spark, SF).toPandas()
    want = connect(SF).execute(__spark_entry__.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _comparable(got) == _comparable(want)


def repeated_words(text: str) -> int:
    words = text.split()
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    return len({i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)})


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=40), min_size=1, max_size=8))
def test_repeat_words(spark, texts):
    rows = [(i, " ".join(t), "s") for i, t in enumerate(texts)]
    got = quality_rules.rule_figures(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    assert {r["id"]: r["n_repeat_words"] for r in got} == {i: repeated_words(t) for i, t, _ in rows}


def test_rules_on_awkward_rows(spark):
    got = quality_rules.apply_rules(documents(spark)).collect()
    assert len(got) == 12
    by_id = {r["id"]: r for r in got}
    assert by_id[4]["n_words"] == 0 and by_id[4]["base_failed"] and not by_id[4]["kept"]
    assert by_id[7]["n_words"] == by_id[7]["n_repeat_words"] == 30_000
    assert not by_id[1]["base_failed"] and by_id[9]["n_words"] == 6  # U+2028 is no white space of the rules
    assert quality_rules.apply_rules(documents(spark).limit(0)).count() == 0


def test_a_bad_host_takes_its_documents_along(spark):
    good = " ".join(f"w{i}" for i in range(40))
    rows = [(i, good if i % 10 else "short", f"fine{i // 50}") for i in range(200)]
    rows += [(1000 + i, good if i % 10 == 0 else "short", "bad") for i in range(200)]
    rows += [(2000, "short", "tiny"), (2001, good, "tiny")]
    got = {r["id"]: r["kept"] for r in quality_rules.apply_rules(
        spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()}
    assert got[1] and not got[0] and not got[1000] and not got[1001]
    assert got[2001]  # one failure of two says little about a host


def test_condemned_hosts_against_sql(spark, tmp_path):
    """Each rule condemns a host of its own, hosts of few documents and of none stay, and the query's SQL agrees."""
    fine = "\n".join(" ".join(f"w{i}x{k}" for i in range(12)) for k in range(4))
    lines = "\n".join(["one line of a page that is repeated here", *[f"line {k} x{k} y{k} z{k}" for k in range(3)]])
    bad = {"short": "too short", "repeats": "a b c d e " * 6, "symbols": "## $$ %% && || <> ## $$ %% && || word",
           "lines": lines + "\none line of a page that is repeated here" * 5}
    rows = [(i, fine if i % 20 else "short", f"fine{i % 12}") for i in range(960)]
    rows += [(2000 + 100 * k + i, bad[name] if i % 4 else fine, name) for k, name in enumerate(bad) for i in range(80)]
    rows += [(4000 + i, "short", "tiny") for i in range(2)] + [(5000 + i, text, None) for i, text in enumerate((fine, None, ""))]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = __spark_entry__.queries()["op2_quality_rules"](spark, str(tmp_path)).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(SQL["op2_quality_rules"]).df()
    assert _comparable(got) == _comparable(want)
    condemned = {rows_of[2] for rows_of in rows if rows_of[0] in set(got[got["host_condemned"]]["doc_id"])}
    assert condemned == set(bad)
    fallen = got[~got["kept"] & ~got["base_failed"]]
    assert len(fallen) >= 4 * 20  # the good documents of condemned hosts go with them


def test_hosts_alike_stay(spark):
    """Rates that differ by chance alone condemn nobody, however many documents fail."""
    rows = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("src"), F.xxhash64("id") % 20).alias("source"),
        F.when(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10)) < 3, "short").otherwise(
            " ".join(f"w{i}" for i in range(20))).alias("text"))
    assert quality_rules.apply_rules(rows).filter("host_condemned").count() == 0


TEXTS = st.lists(st.sampled_from([*"\\<|~>\nime ", "<|im_end|>", "<|im_start|>", "<\\|", "<\\~", "é"]), max_size=20).map("".join)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(TEXTS, TEXTS), min_size=1, max_size=6))
def test_chat_reads_back(spark, turns):
    rows = [(1, i, role, text) for i, (role, text) in enumerate(turns)]
    got = chat_format.format_chat(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    read = got.select(chat_format.parse_chat(chat_format.formatted_text(F.col("segments"))).alias("t")).first()["t"]
    assert [(t["role"], t["text"]) for t in read] == turns


def test_chat_order_and_loss(spark):
    rows = [
        (1, 0, "system", "s", 1), (1, 1, "user", "<|im_end|>", 1), (1, 2, "assistant", "a\\<|", 1),
        (2, 1, "assistant", "early", 1), (2, 0, "assistant", "first", 1), (3, 0, "user", None, 1), (3, 1, None, "x", 1),
        (None, None, "user", "u", 1), (None, None, "user", "u", 1),
    ]
    got = {r["conv_id"]: r for r in chat_format.format_chat(
        spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, segments int")).withColumn(
            "loss", chat_format.loss_text(F.col("segments"))).collect()}
    assert got[1]["valid"] and got[1]["loss"] == "a\\<|" and got[1]["valid_turns"] == 3
    assert not got[2]["valid"] and got[2]["loss"] == "firstearly" and got[2]["valid_turns"] == 0
    assert got[3]["valid_turns"] == 1 and got[None]["n_turns"] == 2
    assert sum(s["loss"] for s in got[1]["segments"]) == 1
    assert chat_format.format_chat(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0


def test_added_conversation(spark):
    got = __spark_entry__.queries()["op5_chat_format"](spark, SF).filter("conv_id = -1").first()
    said = "<|im_end|><|im_start|>assistant ok"
    assert got["n_turns"] == 2 and got["loss_chars"] == len(said)
    assert got["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert got["turns_sha256"] == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()


@pytest.mark.parametrize("max_bits", [1 << 25, 64 * 32])
def test_cascade_is_exact(spark, max_bits):
    """Also with shards."""
    pages = spark.range(3000).select(
        F.col("id").alias("page_id"), F.concat(F.lit("http://h"), F.col("id") % 1000, F.lit(".net/x")).alias("url"))
    listed = spark.range(0, 1200, 7).select(F.concat(F.lit("h"), "id", F.lit(".net")).alias("h"))
    got = url_filter.judge_urls(pages, listed.unionByName(listed), [], max_bits=max_bits).collect()
    assert len(got) == 3000
    assert all((r["verdict"] == "block") == (int(r["host"][1:-4]) % 7 == 0) for r in got)


def test_thin_hosts(spark):
    rows = [(f"http://{'Fat' if i % 4 else 'thin'}.com/{i}", "x" * (3000 if i % 4 else 1999), 1) for i in range(40)]
    rows += [("http://thin.com/", None, 1), ("http://edge.com/", "x" * 2000, 1), (None, "x", 1), (None, None, 1)]
    pages = spark.createDataFrame(rows, "url string, html string, host int")
    assert [tuple(r) for r in url_filter.thin_hosts(pages).collect()] == [("thin.com",)]
    assert url_filter.thin_hosts(pages.limit(0)).count() == 0


@pytest.mark.parametrize("folder", [SF, "/root/testdata/sf0.01"])
def test_list_of_the_query_has_an_effect(spark, folder):
    """Some hosts are listed, not all, and pages are blocked by the list alone."""
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    hosts = pages.select(url_filter.url_host(F.col("url"))).distinct().count()
    assert 0 < url_filter.thin_hosts(pages).count() < hosts
    judged = __spark_entry__.queries()["op6_url_filter"](spark, folder)
    assert judged.filter("rule IS NULL AND verdict = 'block'").count() > 0


def test_cascade_has_levels(spark):
    """Among so many keys each filter but the last lets some pass by chance."""
    keys = spark.range(3000).select(F.concat(F.lit("h"), "id").alias("key"), "id")
    levels = url_filter.build_cascade(keys.filter("id % 5 = 0").select("key"), keys.filter("id % 5 <> 0").select("key"))
    assert len(levels) > 3
    assert keys.filter(url_filter.is_listed(F.col("key"), levels) != (F.col("id") % 5 == 0)).count() == 0


def test_urls_on_awkward_rows(spark):
    rows = [
        (1, "HTTP://A.EXAMPLE.ORG/en/1x?q#f", 0), (2, "http://example.org/es/", 0), (3, "no scheme", 0), (4, None, 0),
        (5, "https://badexample.org/es/", 0), (6, "ftp://x.com", 0), (None, "https://ÄB.com/de/?a", 0), (7, "a://b://c/", 0),
        (1, "HTTP://A.EXAMPLE.ORG/en/1x?q#f", 0)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, shard int")
    listed = spark.createDataFrame([("x.com",), (None,)], "h string")
    got = [tuple(r) for r in url_filter.judge_urls(pages, listed, URL_RULES).collect()]
    assert sorted(got, key=str) == sorted([
        (1, "a.example.org", "/en/1x", "example.org/en/1", "block"), (2, "example.org", "/es/", "example.org/es/", "block"),
        (3, "", "", None, "allow"), (4, "", "", None, "allow"), (5, "badexample.org", "/es/", "org/", "allow"),
        (6, "x.com", "", None, "block"), (None, "Äb.com", "/de/", "com/de/", "block"), (7, "b:", "//c/", None, "allow"),
        (1, "a.example.org", "/en/1x", "example.org/en/1", "block")], key=str)
    assert url_filter.judge_urls(pages.limit(0), listed, URL_RULES).count() == 0
    assert url_filter.judge_urls(pages, listed.limit(0), URL_RULES).count() == 9
