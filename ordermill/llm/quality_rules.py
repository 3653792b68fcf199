"""Quality rules per document, and verdicts on the hosts that the documents come from.

``rule_figures`` measures each whole text inside its row: nothing is exploded or
shuffled.  ``host_verdicts`` adds up the failures of each rule by host, fits a
beta prior to the hosts' rates by their moments, and shrinks each host's rate
towards it, so that a host of three pages isn't condemned by two of them.  How
high a rate condemns follows from the prior too: a host has to be surely (by
two deviations of its posterior) worse than a multiple of what hosts have.
Where hosts differ by chance alone, none is condemned.
``apply_rules`` joins the verdicts of condemned hosts back to the documents.

Defined results: a null or empty text has no words and fails the rule on length.
A document without a host is judged by its own figures alone.  Repeated rows
are judged one by one and count each for their host; an empty table gives an
empty one.  Columns of the input other than those named are not read, so their
names cannot clash.

Main path: DataFrame functions only.  The rows of a hot host are added up before
the shuffle; on the way back only condemned hosts take part in the join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.session import materialize

#: Fixed values of the base rules.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class Limits:
    """Where a document fails a rule, and where a host is condemned.

    A host is condemned if its shrunk rate, less ``host_deviations`` posterior deviations, is above
    ``host_multiple`` times the prior's mean; that limit is kept between ``host_floor`` and ``host_ceiling``.
    """

    min_words: int = 10
    max_repeat_percent: int = 20
    max_symbol_percent: int = 30
    max_dup_line_percent: int = 50
    host_multiple: float = 2.0
    host_deviations: float = 2.0
    host_floor: float = 0.2
    host_ceiling: float = 0.5


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, though named often."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window of five words found twice or more in the text.

    Windows are compared by a 64-bit hash.  Only texts with a window that comes
    again are sorted by (hash, place); from the places of repeated windows, in
    order, each adds as many words as lie before the next one, five at most.
    """
    last = F.size(words) - WINDOW
    windows = F.when(last >= 0, F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    ).otherwise(F.array().cast("array<bigint>"))

    def places(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return _let(ordered, lambda o: F.sort_array(F.transform(
            F.filter(o, lambda x, k: (x["h"] == F.get(o, k - 1)["h"]) | (x["h"] == F.get(o, k + 1)["h"])),
            lambda x: x["i"])))

    def covered(at: Column) -> Column:
        return F.aggregate(
            F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)))),
            F.lit(0), lambda total, x: total + x)

    return _let(windows, lambda hashes: F.when(
        F.size(F.array_distinct(hashes)) < F.size(hashes), _let(places(hashes), covered)).otherwise(F.lit(0)))


def rule_figures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per document: id, host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (long).

    n_lines: lines with a word.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    plain = docs.select(F.col(id_col).alias("id"), F.col(host_col).alias("host"), text.alias("text"))
    split = plain.select(
        "id", "host", "text",
        F.filter(F.split("text", SPACE), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    without = F.col("text")
    for symbol in SYMBOLS:
        without = F.replace(without, F.lit(symbol), F.lit(""))
    words, lines = F.col("words"), F.col("lines")
    figures = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.length("text") - F.length(without),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _repeat_words(words),
    }
    return split.select("id", "host", *[figure.cast("bigint").alias(name) for name, figure in figures.items()])


def rule_failures(limits: Limits = Limits()) -> dict[str, Column]:
    """The rules by name, on the columns of ``rule_figures``."""
    words = F.col("n_words")
    return {
        "short": words < limits.min_words,
        "repeats": 100 * F.col("n_repeat_words") > limits.max_repeat_percent * words,
        "symbols": 100 * F.col("n_symbols") > limits.max_symbol_percent * F.col("word_chars"),
        "dup_lines": 100 * F.col("n_dup_lines") > limits.max_dup_line_percent * F.col("n_lines"),
    }


def host_verdicts(figures: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per host: n_docs, and for each rule failures, shrunk rate and whether it condemns the host.

    The prior of a rule is Beta(m*s, (1-m)*s).  m is the mean of the hosts' rates; s follows from their
    variance less what chance alone gives hosts of their sizes, and is kept between 1 and 1000.
    ``least_<rule>`` is the shrunk rate less the deviations of ``limits``.
    """
    rules = rule_failures(limits)
    hosts = figures.filter(F.col("host").isNotNull()).groupBy("host").agg(
        F.count("*").alias("n_docs"), *[F.count_if(failed).alias(f"n_{name}") for name, failed in rules.items()])
    hosts = materialize(hosts, "host-failures")
    seen = {name: F.col(f"n_{name}") / F.col("n_docs") for name in rules}
    mean = {name: F.coalesce(F.avg(seen[name]), F.lit(0.0)) for name in rules}
    priors = hosts.agg(
        F.coalesce(F.avg(1 / F.col("n_docs")), F.lit(1.0)).alias("noise"),
        *[mean[name].alias(f"m_{name}") for name in rules],
        *[F.coalesce(F.var_pop(seen[name]), F.lit(0.0)).alias(f"v_{name}") for name in rules])
    for name in rules:
        m, v = F.col(f"m_{name}"), F.col(f"v_{name}")
        chance = m * (1 - m)
        spread = F.greatest(v - chance * F.col("noise"), F.lit(1e-9))
        priors = priors.withColumn(f"s_{name}", F.greatest(F.lit(1.0), F.least(F.lit(1000.0), chance / spread - 1)))
    result, condemned = hosts, F.lit(False)
    for name in rules:
        strength = priors.select(f"s_{name}").scalar()
        centre = priors.select(f"m_{name}").scalar()
        rate = F.col(f"rate_{name}")
        deviation = F.sqrt(rate * (1 - rate) / (F.col("n_docs") + strength + 1))
        result = result.withColumn(
            f"rate_{name}", (F.col(f"n_{name}") + centre * strength) / (F.col("n_docs") + strength))
        result = result.withColumn(f"least_{name}", rate - limits.host_deviations * deviation)
        limit = F.greatest(F.lit(limits.host_floor), F.least(F.lit(limits.host_ceiling), limits.host_multiple * centre))
        condemned = condemned | (F.col(f"least_{name}") > limit)
    return result.withColumn("condemned", condemned)


def apply_rules(docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text",
                host_col: str = "source") -> DataFrame:
    """Figures of each document with base_failed, host_condemned and kept (boolean)."""
    figures = materialize(rule_figures(docs, id_col, text_col, host_col), "rule-figures")
    condemned = host_verdicts(figures, limits).filter("condemned").select("host", F.lit(True).alias("condemned"))
    rules = rule_failures(limits)
    judged = figures.join(condemned, "host", "left").withColumns({
        "base_failed": rules["short"] | rules["repeats"],
        "host_condemned": F.coalesce("condemned", F.lit(False))})
    return judged.drop("condemned").withColumn("kept", ~F.col("base_failed") & ~F.col("host_condemned"))
