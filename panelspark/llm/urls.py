"""URL filters: rules first, then the ratio of two character language models.

The models are variable-order Markov chains over the bytes of a URL, one of accepted and one of
rejected URLs: the probability of a byte mixes the counts after its longest context with the
next shorter context's probability, in proportion to what was seen, down to a uniform base. URLs
that a rule decides are the training set, all of them, but for a fifth that calibrates the
threshold. Counts are exact, and a table that grows with the corpus: neither the driver nor a task
holds it. URLs are scored in blocks, and the distinct contexts of a block are joined to the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from panelspark.llm.common import without
from panelspark.sources.sinks import stage

ORDER = 5
BLOCK_BYTES = 1 << 20
SMOOTHING = 4.0
BINS_PER_UNIT = 256
MAX_BIN = 2048
ADDED = ["host", "path", "rule", "score", "verdict"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str) -> tuple[str, str]:
    """SQL for the host (A-Z lower-cased) and the path; empty without `://`."""
    rest = f"CASE WHEN locate('://', {url}) > 0 THEN substring({url}, locate('://', {url}) + 3) END"
    host = f"coalesce(translate(regexp_extract({rest}, '^[^/?#]*', 0), '{UPPER}', '{LOWER}'), '')"
    path = f"coalesce(regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1), '')"
    return host, path


def rule_cases(rules: list[tuple[str, str]]) -> tuple[str, str]:
    """SQL for the longest fitting rule and its action. `rules` is a short stated list of
    (action, host and path); of rules of one length the first in text order wins."""
    rule, action = "CASE", "CASE"
    for verdict, text in sorted(set(rules), key=lambda r: (-len(r[1]), r[1], r[0])):
        host, slash, path = text.partition("/")
        fits = (
            f"(host = '{host}' OR endswith(host, '.{host}')) AND startswith(path, '{slash}{path}')"
        )
        rule += f" WHEN {fits} THEN '{text}'"
        action += f" WHEN {fits} THEN '{verdict}'"
    return f"{rule} END", f"{action} END"


def _codes(urls: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the URLs after their scheme, digits as one, each after ORDER zero bytes, and the
    number of the URL of each byte."""
    plain = [(u or "").partition("://") for u in urls]
    coded = [(p[2] or p[0]).encode("utf-8", "surrogatepass").lower() for p in plain]
    gap = b"\0" * ORDER
    raw = np.frombuffer(b"".join(gap + c for c in coded), np.uint8).copy()
    raw[(raw >= 0x30) & (raw <= 0x39)] = 0x30
    owner = np.repeat(np.arange(len(coded)), [len(c) + ORDER for c in coded])
    return raw, owner


def _keys(raw: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, a whole number for every byte's context and one for the context with it. They
    hold the order and the bytes themselves, so different contexts have different numbers."""
    code = raw.astype(np.int64)
    context = np.zeros(len(raw), np.int64)
    for order in range(ORDER + 1):
        if order:
            context[order:] += code[:-order] << (8 * (order - 1))
        yield (2 * order << 48) + context, (2 * order + 1 << 48) + (context << 8) + code


def _blocks(batch: pa.RecordBatch, url: str) -> Iterator[pa.RecordBatch]:
    """Slices with about BLOCK_BYTES of URLs; a longer URL is a slice of its own."""
    urls = batch.column(batch.schema.get_field_index(url))
    sizes = pc.fill_null(pc.binary_length(urls), 0).to_pylist()
    first, size = 0, 0
    for i, n in enumerate(sizes):
        if size and size + n > BLOCK_BYTES:
            yield batch.slice(first, i - first)
            first, size = i, 0
        size += n
    if first < len(sizes):
        yield batch.slice(first)


def train(labelled: DataFrame) -> DataFrame:
    """(key, rejected, accepted): exact counts over all rows of (url, accepted), staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _blocks(batch, "url"):
                accepted = np.array(block.column(1).to_pylist(), bool)
                raw, owner = _codes(block.column(0).to_pylist())
                real = raw != 0
                good = accepted[owner[real]]
                for pair in _keys(raw):
                    for keys in pair:
                        distinct, at = np.unique(keys[real], return_inverse=True)
                        n = np.bincount(at, minlength=len(distinct))
                        of_good = np.bincount(at[good], minlength=len(distinct))
                        for i in range(0, len(distinct), 50_000):
                            some = slice(i, i + 50_000)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(distinct[some]), pa.array((n - of_good)[some]),
                                 pa.array(of_good[some])], ["key", "rejected", "accepted"],
                            )

    rows = labelled.select("url", "accepted").mapInArrow(
        run, "key long, rejected long, accepted long"
    )
    return stage(rows.groupBy("key").agg(
        F.sum("rejected").alias("rejected"), F.sum("accepted").alias("accepted")
    ))


def difference(urls: list[str | None], keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Log-likelihood under accepted less that under rejected, per byte; 0 for no bytes. `counts`
    has a row per class, rejected first, with the counts of `keys`, which are sorted."""
    raw, owner = _codes(urls)
    real = raw != 0
    owner = owner[real]
    chance = np.full((2, len(owner)), 1 / 256)

    def counted(wanted: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros((2, len(wanted)), np.int64)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, counts[:, at], 0)

    for alone, joint in _keys(raw):
        seen, both = counted(alone[real]), counted(joint[real])
        chance = (both + SMOOTHING * chance) / (seen + SMOOTHING)
    gain = np.log(chance[1]) - np.log(chance[0])
    sums = np.bincount(owner, gain, minlength=len(urls))
    lengths = np.bincount(owner, minlength=len(urls))
    return sums / np.maximum(lengths, 1)


def with_score(pages: DataFrame, counts: DataFrame, url: str = "url") -> DataFrame:
    """Adds `score`. The pages are staged with the number of their block."""
    pages = without(pages, "score", "score_block")
    fields = list(pages.schema.fields)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 33
        for batch in batches:
            for some in _blocks(batch, url):
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array(np.full(some.num_rows, block, np.int64))],
                    [*some.schema.names, "score_block"],
                )
                block += 1

    numbered = stage(pages.mapInArrow(
        number, StructType([*fields, StructField("score_block", LongType())])
    ))

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = batch.column(1).to_numpy()
            cuts = np.flatnonzero(np.diff(blocks)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(blocks)]):
                if a == b:
                    continue
                raw, _ = _codes(batch.column(0).slice(a, b - a).to_pylist())
                real = raw != 0
                for pair in _keys(raw):
                    for keys in pair:
                        distinct = np.unique(keys[real])
                        for i in range(0, len(distinct), 50_000):
                            some = distinct[i : i + 50_000]
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(some), blocks[a])), pa.array(some)],
                                ["of_block", "key"],
                            )

    asked = numbered.select(F.col(f"`{url}`").cast("string"), "score_block").mapInArrow(
        wanted, "of_block long, key long"
    ).distinct()
    # A context occurs at most once per block, so the commonest ones are no larger than the blocks' number.
    found = asked.join(counts, "key").select("of_block", "key", "rejected", "accepted")

    def score(block: pa.Table, model: pa.Table) -> pa.Table:
        model = model.sort_by("key")
        tables = np.stack([model.column(c).to_numpy() for c in ("rejected", "accepted")])
        urls = block.column(url).to_pylist()
        scores = difference(urls, model.column("key").to_numpy(), tables)
        return block.drop_columns("score_block").append_column("score", pa.array(scores))

    return numbered.groupBy("score_block").cogroup(found.groupBy("of_block")).applyInArrow(
        score, StructType([*fields, StructField("score", DoubleType())])
    )


def calibrate(scored: DataFrame) -> float:
    """The threshold with the best balanced accuracy on (score, accepted), of equals the nearest
    to 0; 0 if a class is missing. Scores are counted in bins, so the driver sees 2 * MAX_BIN + 1 rows at most."""
    place = f"CAST(greatest(least(floor(score * {BINS_PER_UNIT}), {MAX_BIN}), -{MAX_BIN}) AS INT)"
    rows = scored.selectExpr(f"{place} AS bin", "accepted").groupBy("bin").agg(
        F.expr("count_if(accepted)").alias("good"), F.expr("count_if(NOT accepted)").alias("bad")
    ).collect()
    good, bad = sum(r["good"] for r in rows), sum(r["bad"] for r in rows)
    if not good or not bad:
        return 0.0
    below_good, below_bad, candidates, last = 0, 0, [], -MAX_BIN - 1
    for r in sorted(rows, key=lambda r: r["bin"]):
        right = (good - below_good) / good + below_bad / bad
        # Any threshold above the last bin and up to this one does the same: the nearest to 0.
        threshold = min(max(0, last + 1), r["bin"]) / BINS_PER_UNIT
        candidates.append((right, -abs(threshold), threshold))
        below_good += r["good"]
        below_bad += r["bad"]
        last = r["bin"]
    return max(candidates)[2]


def judge(pages: DataFrame, rules: list[tuple[str, str]], url: str = "url") -> DataFrame:
    """Adds `host`, `path`, `rule` (the longest that fits, else NULL), `score` and `verdict`
    (allow or block: the rule's, else allow where the score reaches the threshold).

    A NULL URL has empty host and path, fits no rule and scores 0. Without any URL that a rule
    decides both models are uniform, every score is 0 and the verdict allow. Columns named as
    the results are replaced; repeated URLs count as often as they occur and are judged alike; a
    URL of any length is scored whole; an empty table stays empty.
    """
    pages = without(pages, *ADDED, "action")
    host, path = host_and_path(f"`{url}`")
    rule, action = rule_cases(rules)
    ruled = pages.withColumns({"host": F.expr(host), "path": F.expr(path)}).withColumns(
        {"rule": F.expr(rule), "action": F.expr(action)}
    )
    labelled = ruled.where("action IS NOT NULL").selectExpr(
        f"`{url}` AS url", "action = 'allow' AS accepted",
        f"pmod(xxhash64(`{url}`), 5) = 0 AS calibrates",
    )
    counts = train(labelled.where("NOT calibrates"))
    threshold = calibrate(with_score(labelled.where("calibrates"), counts))
    scored = with_score(ruled, counts, url)
    verdict = f"coalesce(action, CASE WHEN score >= {threshold!r}D THEN 'allow' ELSE 'block' END)"
    return scored.withColumn("verdict", F.expr(verdict)).drop("action")
