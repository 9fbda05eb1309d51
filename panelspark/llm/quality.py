"""Quality rules with thresholds that follow the corpus.

Each document gets a few whole-number rates. Per language and source a quantile sketch counts
the documents by rate bucket: a bucket keeps the eight leading bits after the first, so quantiles
are within 1/256 of the true value, and sketches merge by adding counts, in any order and with the
same result. A source with few documents in a language uses the merged sketch of the language.

The fence of a rate lies beyond its upper quartile, by a multiple of the quartile's distance from the
median and the width of the quartile's bucket; a rate bounded from below has the same fence on the other
side. What less than a quarter of a group has at all is thus an outlier in that group. As a few
occurrences in a short document are no rate, a document is beyond a fence only if it still is
without `FREE` of its occurrences, or with `FREE` words more or less. Everything is DataFrame and SQL expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import WORD_SPACE, without
from panelspark.sources.sinks import stage

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
FEW_DOCUMENTS = 50
SPREAD = 8
FREE = 2  # occurrences in a document that tell nothing
BUCKET_BITS = 9


def _excess(count: str, per: str) -> tuple[str, str, str | None]:
    return f"1000 * {count} DIV {per}", f"1000 * greatest({count} - {FREE}, 0) DIV {per}", None


# rate: (definition in thousandths, what is held against the upper fence, and against the lower one)
RATES = {
    "symbol_rate": _excess("n_symbols", "n_words"),
    "dup_line_rate": _excess("n_dup_lines", "n_lines"),
    "stutter_rate": _excess("n_stutters", "n_words"),
    "word_length": (
        "1000 * word_chars DIV n_words",
        f"1000 * word_chars DIV (n_words + {FREE})",
        f"1000 * word_chars DIV greatest(n_words - {FREE}, 1)",
    ),
}
COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stutters",
]
ADDED = [*COUNTS, *RATES, "base_failed", "kept"]


def bucket(value: str) -> str:
    """The smallest value of the bucket: exact below 512, then nine leading bits."""
    shift = f"greatest(length(bin({value})) - {BUCKET_BITS}, 0)"
    return f"shiftleft(shiftright({value}, {shift}), {shift})"


def bucket_width(value: str) -> str:
    return f"shiftleft(1L, greatest(length(bin({value})) - {BUCKET_BITS}, 0))"


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the counts of every whole text and `base_failed`. A NULL text has no words.

    Very long texts are counted whole, an empty table stays empty, and columns named as the
    results are replaced. Windows, and words with the word before (`n_stutters`: alike), are compared by 64-bit hash
    inside one document.
    """
    docs = without(docs, *ADDED)
    body = f"coalesce(`{text}`, '')"
    n = WINDOW
    words = docs.selectExpr(
        "*",
        f"filter(split({body}, r'{WORD_SPACE}'), w -> w <> '') AS q_words",
        rf"filter(split({body}, '\n'), l -> l RLIKE r'[^\x20\x09-\x0D]') AS q_lines",
    )
    hashed = words.selectExpr("*", "transform(q_words, w -> xxhash64(w)) AS q_hashes")
    parts = ", ".join(f"get(q_hashes, i + {k})" for k in range(n))
    windows = hashed.selectExpr(
        "*",
        f"CASE WHEN size(q_words) < {n} THEN CAST(array() AS ARRAY<BIGINT>) ELSE"
        f" transform(sequence(0, size(q_words) - {n}), i -> xxhash64({parts})) END AS q_windows",
    )
    twice = windows.selectExpr(
        "*",
        "CASE WHEN size(array_distinct(q_windows)) = size(q_windows)"
        " THEN CAST(array() AS ARRAY<STRUCT<h: BIGINT, at: INT>>) ELSE"
        " array_sort(transform(q_windows, (h, at) -> struct(h, at))) END AS q_sorted",
    )
    starts = twice.selectExpr(
        "*",
        "array_sort(transform(filter(q_sorted, (x, k) -> x.h = get(q_sorted, k - 1).h"
        " OR x.h = get(q_sorted, k + 1).h), x -> x.at)) AS q_starts",
    )
    counted = starts.selectExpr(
        *[f"`{c}`" for c in docs.columns],
        "CAST(size(q_words) AS BIGINT) AS n_words",
        "CAST(length(array_join(q_words, '')) AS BIGINT) AS word_chars",
        "CAST(size(filter(q_hashes, (h, k) -> h = get(q_hashes, k - 1))) AS BIGINT) AS n_stutters",
        f"CAST(length(regexp_replace({body}, '[^#*$%&|<>]+', '')) AS BIGINT) AS n_symbols",
        "CAST(size(q_lines) AS BIGINT) AS n_lines",
        "CAST(size(q_lines) - size(array_distinct(q_lines)) AS BIGINT) AS n_dup_lines",
        f"aggregate(transform(q_starts, (s, k) -> least({n}, coalesce(get(q_starts, k + 1) - s,"
        f" {n}))), 0L, (a, x) -> a + x) AS n_repeat_words",
    )
    return counted.selectExpr(
        "*",
        f"(n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)"
        " AS base_failed",
        *[f"CASE WHEN n_words > 0 THEN {rate} END AS {name}"
          for name, (rate, _, _) in RATES.items()],
    )


def sketches(counted: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, whole_lang, rate, bucket, n): mergeable counts. `whole_lang` rows are the
    merged sketches of a language. Documents without words have no rates and are not counted."""
    rates = ", ".join(f"struct('{r}' AS rate, {bucket(r)} AS bucket)" for r in RATES)
    by_source = (
        counted.where("n_words > 0")
        .selectExpr(f"`{lang}` AS lang", f"`{source}` AS source", f"inline(array({rates}))")
        .groupBy("lang", "source", "rate", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    levels = (
        "inline(array(struct(source AS source, false AS whole_lang),"
        " struct(CAST(NULL AS STRING) AS source, true AS whole_lang)))"
    )
    return (
        by_source.withColumn("source", F.col("source").cast("string"))
        .selectExpr("lang", "rate", "bucket", "n", levels)
        .groupBy("lang", "source", "whole_lang", "rate", "bucket")
        .agg(F.sum("n").alias("n"))
    )


def fences(sketch: DataFrame) -> DataFrame:
    """(lang, source, <rate>_low, <rate>_high) for every language and source."""
    group = "lang, source, whole_lang, rate"
    placed = sketch.selectExpr(
        "*",
        f"sum(n) OVER (PARTITION BY {group} ORDER BY bucket) AS upto",
        f"sum(n) OVER (PARTITION BY {group}) AS total",
    )
    medians = placed.groupBy("lang", "source", "whole_lang", "rate").agg(
        F.max("total").alias("total"),
        F.expr("min(bucket) FILTER (WHERE 4 * upto >= total)").alias("q25"),
        F.expr("min(bucket) FILTER (WHERE 2 * upto >= total)").alias("q50"),
        F.expr("min(bucket) FILTER (WHERE 4 * upto >= 3 * total)").alias("q75"),
    )
    low = f"q25 - {SPREAD} * (q50 - q25) - {bucket_width('q25')}"
    high = f"q75 + {SPREAD} * (q75 - q50) + {bucket_width('q75')}"
    limits = medians.selectExpr("*", f"{low} AS low", f"{high} AS high")
    wide = limits.groupBy("lang", "source", "whole_lang").agg(
        F.max("total").alias("total"),
        *[F.expr(f"max({side}) FILTER (WHERE rate = '{r}')").alias(f"{r}_{side}")
          for r in RATES for side in ("low", "high")],
    )
    names = [f"{r}_{side}" for r in RATES for side in ("low", "high")]
    whole = wide.where("whole_lang").selectExpr(
        "lang AS of_lang", *[f"{c} AS whole_{c}" for c in names]
    )
    chosen = wide.where("NOT whole_lang").join(
        whole, F.col("lang").eqNullSafe(F.col("of_lang"))
    )
    return chosen.selectExpr(
        "lang AS fence_lang",
        "source AS fence_source",
        *[f"CASE WHEN total < {FEW_DOCUMENTS} THEN whole_{c} ELSE {c} END AS {c}" for c in names],
    )


def judge(counted: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Adds `kept`: not base_failed and inside every fence. Reads `counted` twice: stage it.

    A missing language or source is a group like any other. Equal rows are judged alike, a
    document without words fails, an empty table stays empty, and the columns of `with_counts` and
    of the fences are the operator's own: others of `counted` are kept.
    """
    limits = fences(sketches(counted, lang, source))
    inside = [f"CASE WHEN n_words > 0 THEN {held} END <= {r}_high"
              for r, (_, held, _) in RATES.items()]
    inside += [f"CASE WHEN n_words > 0 THEN {held} END >= {r}_low"
               for r, (_, _, held) in RATES.items() if held]
    joined = counted.join(
        limits,
        F.col(f"`{lang}`").eqNullSafe(F.col("fence_lang"))
        & F.col(f"`{source}`").cast("string").eqNullSafe(F.col("fence_source")),
        "left",
    )
    verdict = f"NOT base_failed AND coalesce({' AND '.join(inside)}, false)"
    return joined.selectExpr(*[f"`{c}`" for c in counted.columns], f"{verdict} AS kept")


def kept_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that pass, with their own columns."""
    names = [f"`{c}`" for c in docs.columns]
    if {c.lower() for c in docs.columns} & set(ADDED):
        docs = docs.select(F.struct(*names).alias("whole_row"), *[
            F.col(c) for c in (f"`{text}`", "lang", "source")
        ])
        names = ["whole_row.*"]
    return judge(stage(with_counts(docs, text))).where("kept").selectExpr(*names)
