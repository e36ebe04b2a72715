"""Quality rules per document, and verdicts on hosts.

Every document is measured once. A document that breaks a base rule goes. Failures are then counted per host, a host's
failure rates are shrunk towards the rates of all hosts by a beta prior fitted to them (method of moments, the binomial
part taken off), and a host whose shrunk rate surely lies above `most` under any rule is rejected; the verdict is joined
back to its documents. A host of few documents stays near the prior, so it is not judged by them alone.

Null and empty texts have no words and fail the base rule. A null host is a host of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WORD, stored, words_of

LEAST_WORDS = 50
REPEAT_PERCENT = 50
SYMBOLS = r"[#*$%&|<>]"
MOST_FAILING = 0.5  # of a host's documents
SURE = 3.0  # standard deviations of the posterior above MOST_FAILING
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeat_words(words: Column, width: int = 3) -> Column:
    """Words that lie in a window of `width` words found twice or more; `words` is a lambda's variable.

    Windows are sorted by hash, those with an equal neighbour are repeated, and the places they cover are added up.
    """
    last = F.size(words) - width
    windows = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.struct(F.xxhash64(*[F.get(words, i + k) for k in range(width)]).alias("h"), i.alias("i")),
    )

    def covered(windows: Column) -> Column:
        def repeated(x: Column, k: Column) -> Column:
            return F.coalesce(F.get(windows, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(
                F.get(windows, k + 1)["h"] == x["h"], F.lit(False)
            )

        places = F.sort_array(F.transform(F.filter(windows, repeated), lambda x: x["i"]))
        return F.aggregate(
            places,
            F.struct(F.lit(0).alias("total"), F.lit(0).alias("end")),
            lambda a, p: F.struct(
                (a["total"] + p + F.lit(width) - F.greatest(p, a["end"])).alias("total"), (p + F.lit(width)).alias("end")
            ),
            lambda a: a["total"],
        )

    # transform() over a single element evaluates the sorted windows once.
    return F.when(last >= 0, F.transform(F.array(F.sort_array(windows)), covered)[0]).otherwise(F.lit(0))


def measured(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """Rows (id, tag, host, the measures, n_lines) of every row; `tag` tells texts under one identifier apart."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    by_word = F.transform(
        F.array(words_of(text)),
        lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"), repeat_words(w).cast("bigint").alias("n_repeat_words")),
    )[0]
    by_line = F.transform(
        F.array(lines),
        lambda x: F.struct(
            F.size(x).cast("bigint").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        ),
    )[0]
    return docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.xxhash64(text).alias("tag"),
        F.col(host_col).alias("host"),
        F.char_length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("bigint").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        by_word.alias("by_word"),
        by_line.alias("by_line"),
    ).select("id", "tag", "host", "by_word.n_words", "word_chars", "n_symbols", "by_line.n_dup_lines",
             "by_word.n_repeat_words", "by_line.n_lines")


def base_failed(least_words: int = LEAST_WORDS) -> Column:
    return (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def rules(least_words: int = LEAST_WORDS) -> dict[str, Column]:
    """What a host's documents are held against; each is true for a failure."""
    words = F.col("n_words")
    return {
        "short": words < least_words,
        "repeats": 100 * F.col("n_repeat_words") > REPEAT_PERCENT * words,
        "symbols": 10 * F.col("n_symbols") > words,
        "dup_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "word_length": (F.col("word_chars") < 3 * words) | (F.col("word_chars") > 10 * words),
    }


def beta_prior(failures: float, documents: float, squares: float, hosts: int) -> tuple[float, float]:
    """Mean and weight (in documents) of the prior. `squares`: sum over hosts of failures squared by documents."""
    mean = failures / documents
    if not 0 < mean < 1:
        return mean, 1.0
    noise = mean * (1 - mean) * hosts / documents
    between = squares / documents - mean * mean - noise
    # Hosts that differ no more than chance has it are taken to be alike.
    return mean, max(1.0, mean * (1 - mean) / between - 1) if between > 0 else documents


def host_verdicts(stats: DataFrame, most: float = MOST_FAILING, sure: float = SURE) -> DataFrame:
    """Rows (host, n_docs, rejected, rate_<rule> after shrinking)."""
    names = list(rules())
    counted = stats.groupBy("host").agg(
        F.count("*").alias("n_docs"), *[F.sum(c.cast("int")).cast("double").alias(f"f_{n}") for n, c in rules().items()]
    )
    hosts = stored(counted, "hosts").df
    # A single row: sums over all hosts.
    sums = hosts.agg(
        F.sum("n_docs").alias("docs"),
        F.count("*").alias("hosts"),
        *[F.sum(f"f_{n}").alias(f"f_{n}") for n in names],
        *[F.sum(F.col(f"f_{n}") * F.col(f"f_{n}") / F.col("n_docs")).alias(f"s_{n}") for n in names],
    ).first()
    rates, bad = [], F.lit(False)
    for n in names:
        mean, weight = beta_prior(sums[f"f_{n}"], sums["docs"], sums[f"s_{n}"], sums["hosts"]) if sums["docs"] else (0.0, 1.0)
        heavy = F.col("n_docs") + F.lit(float(weight))
        rate = (F.col(f"f_{n}") + F.lit(float(mean * weight))) / heavy
        rates.append(rate.alias(f"rate_{n}"))
        bad = bad | (rate - sure * F.sqrt(rate * (1 - rate) / (heavy + 1)) > most)
    return hosts.select("host", "n_docs", bad.alias("rejected"), *rates)


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Rows (id, tag, host, the measures, n_lines, base_failed, host_rejected, kept) of every row of `docs`."""
    stats = stored(measured(docs, id_col, text_col, host_col), "measured").df
    verdicts = host_verdicts(stats).select(F.col("host").alias("judged_host"), "rejected")
    failed = base_failed()
    return stats.join(verdicts, stats["host"].eqNullSafe(verdicts["judged_host"])).select(
        *stats.columns,
        failed.alias("base_failed"),
        F.col("rejected").alias("host_rejected"),
        (~failed & ~F.col("rejected")).alias("kept"),
    )
