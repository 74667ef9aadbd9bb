"""Quality rules with host verdicts, in DataFrame functions only.

Every document is measured in one narrow pass. Rule failures are summed by host, each
host's failure rate is shrunk towards the corpus rate with a beta prior fitted to the
hosts' own rates (empirical Bayes, method of moments), and a host whose shrunk rate is
over the limit has all of its documents rejected.

Only one small row per host and rule set is shuffled. Documents stay where they are:
their measures are written once, and the rejected hosts, counted first, are joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import fresh, let, save, without

WORD_SEPARATOR = r"[\x20\x09-\x0D]+"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Rejected hosts up to this many rows are broadcast (a host name and a flag each).
MAX_BROADCAST_HOSTS = 100_000


def _repeated_words(words: Column, window: int) -> Column:
    """How many words lie in a run of ``window`` words that occurs twice or more.

    Runs are compared by 64-bit hashes of their words. A text whose run hashes are all
    different, the usual case, ends there. Else each run's hash, its low bits replaced
    by the run's place, is sorted as a plain long, and equal runs stand side by side.
    """

    def hashes(w):
        starts = F.sequence(F.lit(0), F.size(w) - window)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)]))

    def covered(h):
        return let(F.pow(F.lit(2), F.ceil(F.log2(F.size(h) + 1))).cast("long") - 1, lambda mask: let(
            F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("long")))),
            lambda order: let(F.transform(order, lambda p: p.bitwiseAND(mask).cast("int")), lambda at: runs(h, at))))

    def runs(h, at):
        # Neighbours at two places also count, should another hash with equal high bits stand between.
        value = lambda k: F.get(h, F.get(at, k))
        twice = lambda x, k: F.coalesce(x == value(k - 1), F.lit(False)) | F.coalesce(
            x == value(k + 1), F.lit(False)) | F.coalesce(x == value(k - 2), F.lit(False)) | F.coalesce(
            x == value(k + 2), F.lit(False))
        found = F.sort_array(F.array_compact(F.transform(at, lambda i, k: F.when(twice(F.get(h, i), k), i))))
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        step = lambda a, i: F.struct(
            (a["n"] + i + window - F.greatest(i, a["end"])).alias("n"), (i + window).alias("end"))
        return F.aggregate(found, start, step, lambda a: a["n"])

    found = let(F.transform(words, lambda x: F.xxhash64(x)), lambda w: let(hashes(w), lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))))
    return F.when(F.size(words) <= window, F.lit(0)).otherwise(found)


def measure(docs: DataFrame, text: str = "text", window: int = 5) -> DataFrame:
    """``docs`` with the five measures of the whole text as long columns.

    - ``n_words``: runs of characters other than the six ASCII spaces;
    - ``word_chars``: code points in words;
    - ``n_symbols``: characters of ``#*$%&|<>``;
    - ``n_dup_lines``: lines with a word that equal an earlier line;
    - ``n_repeat_words``: words in a ``window``-word run found twice or more in the text.

    A null or empty text measures zero throughout. Columns of these names are replaced.
    Lines and windows are compared by 64-bit hashes within one text.
    """
    docs = without(docs, [m for m in MEASURES if m != text])
    words, body = fresh(docs.columns, "_words"), F.coalesce(F.col(text), F.lit(""))
    lines = F.transform(
        F.split(body, "\n"), lambda x: F.when(x.rlike(r"[^\x20\x09-\x0D]"), F.xxhash64(x)))
    dup_lines = let(F.array_compact(lines), lambda a: F.size(a) - F.size(F.array_distinct(a)))
    split = docs.withColumn(words, F.array_remove(F.split(body, WORD_SEPARATOR), ""))
    values = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.length(F.regexp_replace(body, "[^#*$%&|<>]+", "")),
        "n_dup_lines": dup_lines,
        "n_repeat_words": _repeated_words(F.col(words), window),
    }
    return split.withColumns({k: v.cast("long") for k, v in values.items()}).drop(words)


def base_failed(min_words: int = 10, max_repeat_percent: int = 20) -> Column:
    """The document's own rules: too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def host_rates(measured: DataFrame, host: str, failed: str) -> DataFrame:
    """One row per host: documents, failures, and the failure rate shrunk by a beta prior.

    The prior's mean is the corpus rate m. Its strength s is m(1-m)/v - 1, v being the
    variance of the hosts' rates less what binomial noise alone would give, kept within
    1 and 1,000,000 (one host, or hosts that do not differ: 1,000,000). The shrunk rate
    is (failures + s m) / (documents + s). A null host is a host of its own.
    The hosts' counts are written once, so ``measured`` is read once.
    """
    n, f = F.col("host_docs"), F.col("host_failures")
    hosts = save(measured.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("host_docs"), F.sum(F.col(failed).cast("long")).alias("host_failures")), "host-counts")
    total = hosts.agg(
        (F.sum(f) / F.sum(n)).alias("m"), F.var_pop(f / n).alias("v"), F.avg(1 / n).alias("noise"))
    m, v, noise = total.first()  # one row of three numbers
    between = (v or 0) - (m or 0) * (1 - (m or 0)) * (noise or 0)
    strength = min(max(m * (1 - m) / between - 1, 1.0), 1e6) if between > 0 else 1e6
    return hosts.withColumn("host_rate", (f + (m or 0) * strength) / (n + strength))


def quality_rules(docs: DataFrame, text: str = "text", host: str = "source", max_host_rate: float = 0.5,
                  min_words: int = 10, max_repeat_percent: int = 20, carry_all: bool = True) -> DataFrame:
    """``docs`` with measures, ``base_failed``, ``host_rejected`` and ``kept``.

    ``kept`` is false for a document that fails its own rules and for every document of a
    host whose shrunk failure rate is over ``max_host_rate``. Rows are never merged:
    repeated rows each count and each come back. An empty table gives an empty result.
    With ``carry_all=False`` the text is dropped and the measured rows are written once;
    else texts are measured twice, for the hosts and for the result, and not written.
    """
    out = [*MEASURES, "base_failed", "host_rejected", "kept"]
    docs = without(docs, [c for c in out if c not in (text, host)])
    measured = measure(docs, text).withColumn("base_failed", base_failed(min_words, max_repeat_percent))
    if not carry_all:
        measured = save(measured.drop(text), "quality-measures")
    rejected = host_rates(measured, host, "base_failed").filter(F.col("host_rate") > max_host_rate)
    key, flag = fresh(measured.columns, "_host"), "host_rejected"
    rejected = save(rejected.select(F.col("host").alias(key), F.lit(True).alias(flag)), "rejected-hosts")
    if rejected.count() <= MAX_BROADCAST_HOSTS:
        rejected = F.broadcast(rejected)
    joined = measured.join(rejected, F.col(host).eqNullSafe(F.col(key)), "left")
    return joined.drop(key).withColumn(flag, F.coalesce(F.col(flag), F.lit(False))).withColumn(
        "kept", ~F.col("base_failed") & ~F.col(flag))
