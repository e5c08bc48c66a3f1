"""Quality rules with host verdicts: rule failures per host, shrunk by an empirical beta prior."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicframe.llm.common import WORD, pick, text_udf
from civicframe.session import materialise

SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def text_measures(text: str | None, min_words: int = 50) -> tuple[int, int, int, int, int, bool]:
    """The five measures of one text, and whether the base rules reject it. Null counts as empty."""
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    repeated = words_in_repeated_triples(words)
    failed = len(words) < min_words or 100 * repeated > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated, failed)


def words_in_repeated_triples(words: list[str]) -> int:
    """Words inside some three-word window that occurs twice or more in the text, the first included."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) >= 1 << 20:  # so that the next product stays inside 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    triples = pairs[:-1] * len(number) + ids[2:]
    order = np.argsort(triples, kind="stable")
    equal = triples[order][1:] == triples[order][:-1]
    covered = np.zeros(n, bool)
    for start in (order[1:][equal], order[:-1][equal]):
        for offset in range(3):
            covered[start + offset] = True
    return int(covered.sum())


def measures(text: Column, min_words: int = 50) -> Column:
    """A struct of the measures and ``base_failed`` of a text column."""
    schema = ", ".join(f"{m} bigint" for m in MEASURES) + ", base_failed boolean"
    return text_udf(schema, lambda: lambda t: text_measures(t, min_words))(text)


def host_verdicts(measured: DataFrame, host: str = "host", max_rate: float = 0.8) -> DataFrame:
    """One row per host: n, fails, rate shrunk towards the corpus, and ``host_rejected``.

    The failure rates of hosts are taken as beta distributed. Its mean is the corpus rate; its strength is
    found from the spread of host rates beyond what binomial noise explains. Without such a spread every host gets
    the corpus rate. A host is rejected when its shrunk rate is above ``max_rate``. The null host is a host.
    """
    hosts = materialise(measured.groupBy(host).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("bigint")).alias("fails")))
    total, failed, squares, many = hosts.agg(
        F.sum("n"), F.sum("fails"), F.sum(F.col("fails") * F.col("fails") / F.col("n")), F.count(F.lit(1))).first()
    if not total:
        return hosts.select(host, "n", "fails", F.lit(0.0).alias("rate"), F.lit(False).alias("host_rejected"))
    mean = failed / total
    spread = squares / total - mean * mean - mean * (1 - mean) * (many - 1) / total
    if spread <= 0:
        rate = F.lit(mean)
    else:
        strength = max(mean * (1 - mean) / spread - 1, 0.0)
        rate = (F.col("fails") + F.lit(mean * strength)) / (F.col("n") + F.lit(strength))
    return hosts.select(host, "n", "fails", rate.alias("rate"), (rate > F.lit(max_rate)).alias("host_rejected"))


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", min_words: int = 50,
          max_rate: float = 0.8) -> DataFrame:
    """Measures, ``base_failed``, the host's shrunk rate and ``kept`` for every row of ``docs``.

    A document is kept if it passes the base rules and its host is not rejected. Null and empty texts have no words
    and fail; null hosts form one host; repeated rows are judged each; an empty table gives an empty table; other
    columns of ``docs`` are not read. Every host's counts cover all its documents.
    """
    rows = materialise(pick(docs, doc_id=doc_id, host=host, text=text).select(
        "doc_id", "host", measures(F.col("text"), min_words).alias("m")).select("doc_id", "host", "m.*"))
    hosts = materialise(host_verdicts(rows, "host", max_rate))
    joined = rows.join(hosts.select(F.col("host").alias("h"), "rate", "host_rejected"), F.col("host").eqNullSafe(F.col("h")))
    kept = ~F.col("base_failed") & ~F.col("host_rejected")
    return joined.select("doc_id", *MEASURES, "base_failed", F.col("rate").alias("host_rate"), kept.alias("kept"))


def filter_documents(docs: DataFrame, text: str = "text", host: str = "source", min_words: int = 50,
                     max_rate: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, with the columns of ``docs``.

    Texts are measured twice, once for the hosts and once for the filter, and are never shuffled by host
    unless the table of rejected hosts outgrows Spark's broadcast threshold.
    """
    failed = measures(F.col("text"), min_words)["base_failed"]
    hosts = host_verdicts(pick(docs, host=host, text=text).select("host", failed.alias("base_failed")), "host", max_rate)
    rejected = materialise(hosts.where("host_rejected").select("host", F.lit(True).alias("bad")))
    names = list(docs.columns)
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    passed = inner.where(~measures(F.col(f"c{names.index(text)}"), min_words)["base_failed"])
    good = passed.join(rejected, passed[f"c{names.index(host)}"].eqNullSafe(rejected["host"]), "left_anti")
    return good.toDF(*names)
