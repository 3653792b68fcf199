"""URL verdicts: a few host and path rules first, then an exact host list kept in a cascade of Bloom filters.

The first filter holds the listed keys.  Of all keys of the corpus, some that
are not listed pass it by chance; the second filter holds those, the third the
listed keys that pass the second by chance, and so on until nobody passes by
chance.  For keys of that universe the cascade then answers exactly, with a few
bits a key and without a join: the filters are scalar values of the query.

Size: ``max_bits`` bounds each filter.  Longer lists are dealt into shards by a
hash of the key, each with a cascade of its own, so that no filter grows; then
the parsed rows are read shard by shard from a table partitioned by shard.

Defined results: a null URL, or one without ``://``, has an empty host and path,
fits no rule, and is not listed unless the empty key is.  Repeated rows are
judged one by one; repeated and null listed keys count once and not at all.
Empty tables give empty results; other columns are not read.
DataFrame functions only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.session import materialize, scratch_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Level:
    """One filter: ``words`` is a scalar array<bigint> of bits, read by ``hashes`` places out of ``bits``."""

    number: int
    bits: int
    hashes: int
    words: Column


def url_host(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def thin_hosts(pages: DataFrame, url_col: str = "url", html_col: str = "html", min_chars: int = 2000,
               excess: float = 1.1) -> DataFrame:
    """Hosts (column host) whose share of thin pages is above ``excess`` times that of all pages.

    A page is thin if its source has fewer than ``min_chars`` code points; a null one has none.  Pages
    without a host count for the share of all only.  Repeated rows count each; without pages there is no host.
    """
    chars = F.coalesce(F.length(html_col), F.lit(0))
    hosts = pages.select(url_host(F.col(url_col)).alias("host"), (chars < min_chars).alias("thin")).groupBy("host").agg(
        F.count("*").alias("n_pages"), F.count_if("thin").alias("n_thin"))
    hosts = materialize(hosts, "thin-pages")
    of_all = hosts.agg(F.sum("n_thin") / F.sum("n_pages")).scalar()
    return hosts.filter((F.col("host") != "") & (F.col("n_thin") / F.col("n_pages") > excess * of_all)).select("host")


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """struct<rule, verdict> of the longest fitting rule (ties: the name, then block before allow), else null.

    One expression for each rule: meant for tens of hand-written rules, not for lists.
    """
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name, -ord(r.verdict[0])), reverse=True):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        best = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(best)
    return best


def _place(key: Column, level: int, turn: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(level), F.lit(turn), key), F.lit(bits))


def passes(key: Column, level: Level) -> Column:
    hit = F.lit(True)
    for turn in range(level.hashes):
        at = _place(key, level.number, turn, level.bits)
        word = F.get(level.words, F.shiftright(at, 6).cast("int"))
        hit = hit & (F.call_function("shiftright", word, at.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1)
    return hit


def build_level(keys: DataFrame, n_keys: int, rate: float, number: int) -> Level:
    """A filter over ``keys`` (column key) that lets about ``rate`` of other keys pass."""
    bits = 64 * max(1, math.ceil(n_keys * math.log(1 / rate) / math.log(2) ** 2 / 64))
    hashes = max(1, round(bits / max(n_keys, 1) * math.log(2)))
    hashes = min(hashes, 20)
    places = keys.select(F.explode(F.array(*[_place(F.col("key"), number, t, bits) for t in range(hashes)])).alias("at"))
    spark = keys.sparkSession
    filled = places.select(
        F.shiftright("at", 6).alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("at").bitwiseAND(F.lit(63)).cast("int")).alias("bits"))
    blank = spark.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    words = filled.unionByName(blank).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    words = materialize(words, f"filter-{number}")
    ordered = words.agg(F.transform(
        F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias("words"))
    return Level(number, bits, hashes, ordered.scalar())


def build_cascade(listed: DataFrame, others: DataFrame, first_number: int = 0) -> list[Level]:
    """Filters over distinct ``listed`` keys that answer exactly for them and for the ``others`` (column key)."""
    inside, outside = materialize(listed, "listed"), materialize(others, "unlisted")
    n_inside, n_outside = inside.count(), outside.count()
    # The first filter leaves about as many by chance as the list has; each later one halves.
    rate = min(0.5, max(1e-6, n_inside / max(1, n_outside) * math.sqrt(0.5)))
    levels: list[Level] = []
    while n_inside:
        levels.append(level := build_level(inside, n_inside, rate, first_number + len(levels)))
        passed = materialize(outside.filter(passes(F.col("key"), level)), f"by-chance-{level.number}")
        inside, outside, n_inside, n_outside = passed, inside, passed.count(), n_inside
        rate = 0.5
    return levels


def is_listed(key: Column, levels: list[Level]) -> Column:
    answer = F.lit(False)
    for number, level in reversed(list(enumerate(levels))):
        # Past the filter of listed keys: listed, unless the next filter knows better; and the other way round.
        answer = passes(key, level) & ~answer
    return answer


def judge_urls(pages: DataFrame, listed: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url",
               max_bits: int = 1 << 25) -> DataFrame:
    """page_id, host, path, rule and verdict (block or allow) of every row.

    ``listed`` has the blocked hosts in its first column.
    """
    spark = pages.sparkSession
    url = F.col(url_col)
    parsed = pages.select(
        F.col(id_col).alias("page_id"), url_host(url).alias("host"), url_path(url).alias("path"))
    keys = listed.select(F.col(listed.columns[0]).alias("key")).filter(F.col("key").isNotNull()).distinct()
    keys = materialize(keys, "listed-keys")
    shards = max(1, math.ceil(keys.count() * 32 / max_bits))

    def shard(key: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(-1), key), F.lit(shards)).cast("int")

    folder = scratch_folder(spark, "parsed-urls") + "/rows"
    parsed.withColumn("shard", shard(F.col("host"))).write.partitionBy("shard").parquet(folder)
    stored = spark.read.schema("page_id " + dict(parsed.dtypes)["page_id"] + ", host string, path string, shard int").parquet(folder)
    universe = materialize(stored.groupBy("shard", F.col("host").alias("key")).agg(F.lit(1).alias("in_corpus")), "universe")
    known = materialize(
        universe.join(keys.withColumn("listed", F.lit(True)), "key", "left"), "known-keys")

    result = None
    for number in range(shards):
        here = known.filter(F.col("shard") == number)
        levels = build_cascade(here.filter("listed").select("key"), here.filter("listed IS NULL").select("key"))
        rows = stored.filter(F.col("shard") == number)
        rule = matching_rule(F.col("host"), F.col("path"), rules)
        judged = rows.withColumn("fit", rule).select(
            "page_id", "host", "path", F.col("fit.rule").alias("rule"),
            F.coalesce("fit.verdict", F.when(is_listed(F.col("host"), levels), "block").otherwise("allow")).alias("verdict"))
        result = judged if result is None else result.unionByName(judged)
    return result
