"""Line dedup by a log-template tree of fixed depth.

A line's tokens are its runs of non-space characters; a token with a digit is a variable field.
The tree's path is the token count and the first `DEPTH` tokens. Inside a leaf, a token that
fewer than `MIN_DOCS` documents share at its position is a variable field too. The template is
the line with its fields written <*>; a line that would keep fewer than half of its tokens stays
its own template. A template found in at least `MIN_DOCS` documents is recurring: its lines stay
in the first document that has it and are dropped from all others.

Everything is DataFrame and SQL expressions. A bit table of fixed size tells which
leading tokens recur often enough; only their lines are examined further, and repeated lines are
counted before their tokens are taken apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import WORD_SPACE, without
from panelspark.sources.sinks import stage

DEPTH = 3
MIN_DOCS = 10
FIELD = "<*>"
FILTER_BITS = 22
ADDED = ["n_lines", "n_dropped"]

_TOKENS = f"filter(split(line, r'{WORD_SPACE}'), t -> t <> '')"
_MASKED = f"transform(tokens, t -> CASE WHEN t RLIKE '[0-9]' THEN '{FIELD}' ELSE t END)"


def keyed(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds `doc_key`: rows with the same id and text share it and are treated alike."""
    key = f"unhex(md5(concat_ws(':', CAST(`{id_column}` AS STRING), `{text}`)))"
    return docs.withColumn("doc_key", F.expr(key))


def raw_lines(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_key, id, line_no, line, lead) for every line with a token. `lead` is its masked first
    tokens: the tree's path but for the token count, found without taking the whole line apart."""
    space, other = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
    head = f"{other}+(?:{space}+{other}+){{0,{DEPTH - 1}}}"
    rows = docs.selectExpr(
        "doc_key",
        f"`{id_column}` AS id",
        rf"posexplode(split(`{text}`, '\n')) AS (line_no, line)",
    )
    return rows.selectExpr(
        "*",
        f"regexp_replace(regexp_replace(regexp_extract(line, r'{head}', 0), r'{space}+', ' '),"
        f" '[^ ]*[0-9][^ ]*', '{FIELD}') AS lead",
    ).where("lead <> ''")


def leaves(lines: DataFrame) -> DataFrame:
    """Adds `leaf`, the tree's whole path, and normalises the line's spaces."""
    tokens = lines.selectExpr("doc_key", "id", "line_no", "lead", f"{_TOKENS} AS tokens")
    return tokens.selectExpr(
        "doc_key", "id", "line_no", "array_join(tokens, ' ') AS line",
        "concat_ws(' ', size(tokens), lead) AS leaf",
    ).withColumn("line_key", F.expr("unhex(md5(line))"))


def templates(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(leaf, line_key, template) of the distinct lines in leaves of enough documents."""
    often = (
        lines.select("leaf", "doc_key").distinct()
        .groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where(f"n >= {min_docs}")
    )
    own = lines.join(stage(often.select("leaf")), "leaf", "left_semi")
    # A line once per document that has it: a document counts once for a token of a leaf, however
    # many of its lines there have that token at that place.
    held = own.groupBy("leaf", "line_key", "doc_key").agg(F.min("line").alias("line"))
    held = stage(held)
    distinct = held.groupBy("leaf", "line_key").agg(
        F.min("line").alias("line"), F.count(F.lit(1)).alias("n_docs")
    )
    tokens = distinct.selectExpr(
        "leaf", "line_key", "n_docs", "split(line, ' ') AS tokens"
    ).selectExpr("leaf", "line_key", "n_docs", f"posexplode({_MASKED}) AS (at, token)")
    tokens = stage(tokens)
    counts = tokens.where(f"token <> '{FIELD}'").groupBy("leaf", "at", "token").agg(
        F.sum("n_docs").alias("pairs"), F.count(F.lit(1)).alias("lines"),
        F.max("n_docs").alias("most"),
    )
    # Pairs of line and document bound the documents from above, the line that most documents have
    # from below; documents are counted one by one only where the two leave it open.
    counts = stage(counts.where(f"pairs >= {min_docs}"))
    clear = counts.where(f"most >= {min_docs}").select("leaf", "at", "token")
    doubt = counts.where(f"most < {min_docs}").select("leaf", "at", "token")
    counted = (
        tokens.join(doubt, ["leaf", "at", "token"]).select("leaf", "line_key", "at", "token")
        .join(held.select("leaf", "line_key", "doc_key"), ["leaf", "line_key"])
        .select("leaf", "at", "token", "doc_key").distinct()
        .groupBy("leaf", "at", "token").agg(F.count(F.lit(1)).alias("support"))
        .where(f"support >= {min_docs}").select("leaf", "at", "token")
    )
    shared = clear.unionByName(counted).withColumn("constant", F.lit(True))
    marked = tokens.join(shared, ["leaf", "at", "token"], "left")
    parts = marked.groupBy("leaf", "line_key").agg(
        F.expr(f"array_sort(collect_list(struct(at, CASE WHEN constant THEN token"
               f" ELSE '{FIELD}' END AS token)))").alias("parts"),
        F.expr("count_if(constant)").alias("n_constant"),
    )
    return parts.selectExpr(
        "leaf",
        "line_key",
        "CASE WHEN 2 * n_constant >= size(parts)"
        " THEN concat('~', array_join(transform(parts, p -> p.token), ' '))"
        " ELSE concat('=', hex(line_key)) END AS template",
    )


def often_bits(lines: DataFrame, min_docs: int) -> Column:
    """A bit table of fixed size as one array of longs: which leads have enough lines.

    Leads that share a bit are counted together, so no line is lost; what passes by chance only
    costs work, as templates are counted exactly afterwards.
    """
    often = lines.groupBy("bit").agg(F.count(F.lit(1)).alias("n")).where(f"n >= {min_docs}")
    words = often.groupBy(F.expr("bit DIV 64").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(bit % 64 AS INT)))").alias("mask")
    )
    every = lines.sparkSession.range((1 << FILTER_BITS) // 64).withColumnRenamed("id", "word")
    dense = every.join(words, "word", "left").selectExpr("word", "coalesce(mask, 0L) AS mask")
    return dense.agg(F.expr(
        "transform(array_sort(collect_list(struct(word, mask))), w -> w.mask)"
    ).alias("table")).scalar()


def dropped_lines(docs: DataFrame, id_column: str, text: str, min_docs: int) -> DataFrame:
    """(doc_key, dropped): the line numbers each document loses. `docs` has `doc_key`."""
    lines = raw_lines(docs, id_column, text).withColumn(
        "bit", F.expr(f"shiftrightunsigned(xxhash64(lead), {64 - FILTER_BITS})")
    )
    lines = stage(leaves(lines.withColumn("table", often_bits(lines, min_docs)).where(
        "shiftright(get(table, CAST(bit DIV 64 AS INT)), CAST(bit % 64 AS INT)) & 1 = 1"
    )))
    # Staged, so that the joins shuffle both sides and a hot line or template can be split.
    found = stage(templates(lines, min_docs))
    matched = lines.join(found, ["leaf", "line_key"])
    matched = stage(matched.select("doc_key", "id", "line_no", F.xxhash64("leaf").alias("leaf"),
                                   F.unhex(F.md5("template")).alias("template")))
    holders = matched.groupBy("leaf", "template", "doc_key").agg(F.min("id").alias("id"))
    recurring = stage(holders.groupBy("leaf", "template").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.expr("min(struct(id IS NULL AS without, id, doc_key))").alias("first"),
    ).where(f"n_docs >= {min_docs}").selectExpr("leaf", "template", "first.doc_key AS first_key"))
    lost = matched.join(recurring, ["leaf", "template"]).where("doc_key <> first_key")
    return lost.groupBy("doc_key").agg(F.collect_set("line_no").alias("dropped"))


def drop_recurring(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS
) -> DataFrame:
    """The documents with recurring lines dropped from the text, `n_lines` (with a token) and
    `n_dropped`.

    The first document is the one with the smallest id, NULL last, then the smallest digest. A
    line that a document repeats is dropped or kept in all its places. A NULL text stays NULL;
    an empty table gives an empty table; columns named as the results are replaced.
    """
    docs = without(docs, *ADDED, "doc_key", "dropped", "line_parts")
    rows = keyed(docs, id_column, text)
    joined = rows.join(dropped_lines(rows, id_column, text, min_docs), "doc_key", "left")
    parts = joined.withColumn("line_parts", F.expr(rf"split(`{text}`, '\n')"))
    left = (
        "array_join(transform(array_except(sequence(0, size(line_parts) - 1), dropped),"
        r" i -> get(line_parts, i)), '\n')"
    )
    return parts.selectExpr(
        *[f"CASE WHEN dropped IS NULL THEN `{c}` ELSE {left} END AS `{c}`" if c == text
          else f"`{c}`" for c in docs.columns],
        r"CAST(coalesce(size(filter(line_parts, l -> l RLIKE r'[^\x20\x09-\x0D]')), 0) AS BIGINT)"
        " AS n_lines",
        "CAST(coalesce(size(dropped), 0) AS BIGINT) AS n_dropped",
    )
