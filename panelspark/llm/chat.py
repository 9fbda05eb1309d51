r"""Chat formatting with a grammar round trip.

The grammar of a formatted conversation:

    conversation := turn*
    turn         := "<s>" mark text "</s>"
    mark         := "[INST]" | "[/INST]" | "[SYS]" | "[ROLE=" hex "]"

for user, assistant, system and any other role. A control string is any of these outside its
place, also with backslashes after its first character; escaping adds one backslash there and
reading takes one away, so it can always be undone. Each conversation is rendered as it is,
read back by the grammar, and compared with its turns. If they differ, its texts are escaped, and it is
rendered, read and compared again. Everything is DataFrame and SQL expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import without

CONTROL = r"(<|\[)(\\*)(/?s>|/?INST\]|SYS\]|ROLE=)"
MARKS = {"user": "[INST]", "assistant": "[/INST]", "system": "[SYS]"}
LOSS_ROLE = "assistant"


def mark(role: str) -> str:
    cases = " ".join(f"WHEN '{r}' THEN '{m}'" for r, m in MARKS.items())
    return f"CASE {role} {cases} ELSE concat('[ROLE=', hex(encode({role}, 'UTF-8')), ']') END"


def escape(text: str) -> str:
    r"""One backslash more after the first character of every control string."""
    return rf"regexp_replace({text}, r'{CONTROL}', r'$1\\$2$3')"


def unescape(text: str) -> str:
    pattern = CONTROL.replace(r"(\\*)", r"\\(\\*)")
    return f"regexp_replace({text}, r'{pattern}', '$1$2$3')"


def render(turns: str, escaped: bool) -> str:
    text = escape("t.text") if escaped else "t.text"
    return (
        f"array_join(transform({turns}, t -> concat('<s>', {mark('t.role')}, {text}, '</s>')), '')"
    )


def parse(formatted: str) -> str:
    """The turns (role, text) that the grammar reads, and what it reads for the loss.

    The text up to each `</s>` is a turn. A turn that doesn't begin with `<s>` and a mark, and
    one with a control string in its text, reads as a NULL turn.
    """
    piece = r"^<s>(\[INST\]|\[/INST\]|\[SYS\]|\[ROLE=([0-9A-F]*)\])((?s).*)$"
    roles = " ".join(f"WHEN '{m}' THEN '{r}'" for r, m in MARKS.items())
    begin = f"regexp_extract(p, r'{piece}', 1)"
    body = f"regexp_extract(p, r'{piece}', 3)"
    role = (
        f"CASE {begin} {roles} ELSE decode(unhex(regexp_extract(p, r'{piece}', 2)), 'UTF-8') END"
    )
    bare = CONTROL.replace(r"(\\*)", "")
    return (
        f"transform(filter(split({formatted}, '</s>'), (p, i) -> p <> '' OR"
        f" i < size(split({formatted}, '</s>')) - 1), p -> CASE WHEN {begin} <> ''"
        f" AND NOT {body} RLIKE r'{bare}'"
        f" THEN named_struct('role', {role}, 'text', {unescape(body)}) END)"
    )


def format_conversations(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(conv_id, turns, formatted, escaped, round_trip, loss_spans) per conversation.

    `turns` are the rows in the order of turn, role and text, NULLs first; a NULL role or text is
    empty. Repeated rows are turns of their own; a row without conv_id is a conversation of its
    own, so any number of them is spread. Texts of any length are rendered whole. `loss_spans` are
    [start, end) in code points of the formatted text, one per assistant text. An empty table has no
    conversations; other columns are left out, whatever their names.
    """
    grouped = (
        without(rows.selectExpr(
            f"`{conv_id}` AS conv_id",
            f"CASE WHEN `{conv_id}` IS NULL THEN monotonically_increasing_id() END AS alone",
            f"struct(`{turn}` AS turn, coalesce(CAST(`{role}` AS STRING), '') AS role,"
            f" coalesce(CAST(`{text}` AS STRING), '') AS text) AS t",
        ))
        .groupBy("conv_id", "alone")
        .agg(F.expr("transform(array_sort(collect_list(t), (a, b) -> CASE"
                    " WHEN a.turn <=> b.turn THEN CASE WHEN a.role < b.role THEN -1"
                    " WHEN a.role > b.role THEN 1 WHEN a.text < b.text THEN -1"
                    " WHEN a.text > b.text THEN 1 ELSE 0 END"
                    " WHEN a.turn IS NULL OR a.turn < b.turn THEN -1 ELSE 1 END),"
                    " t -> named_struct('role', t.role, 'text', t.text))").alias("turns"))
    )
    plain = grouped.withColumn("plain", F.expr(render("turns", False)))
    tried = plain.withColumn("read", F.expr(parse("plain"))).withColumn(
        "escaped", F.expr("NOT (coalesce(read = turns, false))")
    )
    formatted = tried.withColumn(
        "formatted", F.expr(f"CASE WHEN escaped THEN {render('turns', True)} ELSE plain END")
    ).drop("plain", "read")
    read = formatted.withColumn("read", F.expr(parse("formatted")))
    spans = (
        "filter(transform(aggregate(transform(split(formatted, '</s>'), p -> length(p)),"
        " named_struct('at', 0, 'ends', CAST(array() AS ARRAY<INT>)),"
        " (a, n) -> named_struct('at', a.at + n + 4, 'ends', concat(a.ends, array(a.at + n)))).ends,"
        " (e, i) -> CASE WHEN get(read, i).role = '" + LOSS_ROLE + "' THEN"
        " named_struct('start', e - length(split(formatted, '</s>')[i]) + "
        f"{len('<s>' + MARKS[LOSS_ROLE])}, 'end', e) END), s -> s IS NOT NULL)"
    )
    return read.selectExpr(
        "conv_id", "turns", "formatted", "escaped", "coalesce(read = turns, false) AS round_trip",
        "read", f"{spans} AS loss_spans",
    )


def loss_text(formatted: str = "formatted", spans: str = "loss_spans") -> str:
    """The text under the loss mask, read from the formatted text and unescaped."""
    cut = f"substring({formatted}, s.start + 1, s.end - s.start)"
    return f"array_join(transform({spans}, s -> {unescape(cut)}), '')"
