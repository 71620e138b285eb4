"""Chat formatting: typed content parts become one marked-up training string per conversation.

DataFrame functions only. A visitor turns each part of a turn into text or into a
placeholder; attachments and the token counts they expand to are kept beside the
string, and loss spans mark what the model is trained on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"

#: What follows the first character of a control string, ours or another template's.
_REST = r"(\|[a-z_]+\|>|/?s>|/?INST\]|</?SYS>>)"
ESCAPE = (r"([<\[])(\\*)" + _REST, r"$1\\$2$3")
UNESCAPE = (r"([<\[])\\(\\*)" + _REST, r"$1$2$3")

#: Tokens an attachment stands for: image patches of 14 x 14 pixels, 25 audio frames a second, 256 a page.
PATCH, FRAMES, PAGE = 14, 25, 256


def escape(text: Column) -> Column:
    """Put a backslash after the first character of every control string; any string can be restored by unescape."""
    return F.regexp_replace(text, *ESCAPE)


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, *UNESCAPE)


def _visit(part: Column) -> Column:
    """One part as (text, mark, kind, ref, tokens): known attachment kinds have a placeholder for a mark, all else has text."""
    kind = F.lower(F.coalesce(part["type"], F.lit("text")))
    size = lambda n: F.ceil(F.greatest(F.coalesce(n, F.lit(PATCH)), F.lit(1)) / F.lit(PATCH))
    tokens = (
        F.when(kind == "image", size(part["width"]) * size(part["height"]))
        .when(kind == "audio", F.ceil(F.greatest(F.coalesce(part["seconds"], F.lit(0.0)), F.lit(0.0)) * FRAMES))
        .when(kind == "document", F.greatest(F.coalesce(part["pages"], F.lit(1)), F.lit(0)) * PAGE)
    )
    mark = F.lit(None).cast("string")
    for name, placeholder in PLACEHOLDERS.items():
        mark = F.when(kind == name, F.lit(placeholder)).otherwise(mark)
    return F.struct(F.coalesce(part["text"], F.lit("")).alias("text"), mark.alias("mark"), kind.alias("kind"), part["ref"].alias("ref"), tokens.cast("long").alias("tokens"))


def _render(parts: Column) -> Column:
    """The visited parts as one string. Neighbouring texts are joined before they are escaped, so that no control string forms where they meet."""
    nothing = F.struct(F.lit("").alias("done"), F.lit("").alias("open"))

    def add(acc: Column, p: Column) -> Column:
        plain = p["mark"].isNull()
        return F.struct(
            F.when(plain, acc["done"]).otherwise(F.concat(acc["done"], escape(acc["open"]), p["mark"])).alias("done"),
            F.when(plain, F.concat(acc["open"], p["text"])).otherwise(F.lit("")).alias("open"))

    return F.aggregate(parts, nothing, add, lambda acc: F.concat(acc["done"], escape(acc["open"])))


def text_part(text: Column) -> Column:
    """A plain text as the one content part of its turn."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"))).cast(
        "array<struct<type:string,text:string>>"
    )


def _full(content: Column, fields: set[str]) -> Column:
    """The parts with every field of PART; those that the input lacks are null."""
    kinds = dict(x.split(":") for x in PART[7:-1].split(","))
    return F.transform(
        content, lambda p: F.struct(*[(p[n] if n in fields else F.lit(None)).cast(t).alias(n) for n, t in kinds.items()])
    )


def format_chat(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", content: str = "content",
                train_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv, n_turns, formatted, loss_spans, attachments, expanded_tokens.

    content is an array of parts (fields of PART, any subset that has type).
    loss_spans holds (start, length) in code points of each body of train_role;
    attachments holds (turn_no, part_no, kind, ref, tokens) in order of placeholders.
    Rows go by turn (nulls first), ties by role and content, so repeated rows all
    count. Null role, text or content: empty. Null conv: one conversation of its
    own. Other columns of df are ignored. A conversation is one output string, so
    its turns meet in one task; nothing else is gathered.
    """
    fields = set(df.schema[content].dataType.elementType.names)
    rows = df.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.transform(F.coalesce(_full(F.col(content), fields), F.array().cast(f"array<{PART}>")), _visit).alias("parts"),
    )
    rows = rows.select(
        "conv", "turn", "role", "parts",
        F.concat(F.lit(TURN), escape(F.col("role")), F.lit(BODY)).alias("head"),
        _render(F.col("parts")).alias("body"),
    )
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "body", F.to_json("parts"))
    whole = F.length("head") + F.length("body") + len(END)
    rows = rows.withColumns({
        "no": F.row_number().over(order),
        "start": F.coalesce(F.sum(whole).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.length("head"),
    })
    found = F.filter(
        F.transform("parts", lambda p, i: F.struct(
            F.col("no").alias("turn_no"), (i + 1).alias("part_no"), p["kind"].alias("kind"), p["ref"].alias("ref"),
            p["tokens"].alias("tokens"))),
        lambda p: p["tokens"].isNotNull(),
    )
    one = F.struct(
        "no", F.concat("head", "body", F.lit(END)).alias("segment"),
        F.when(F.col("role") == train_role, F.struct(F.col("start").cast("long").alias("start"), F.length("body").cast("long").alias("length"))).alias("span"),
        found.alias("found"),
    )
    got = rows.groupBy("conv").agg(F.sort_array(F.collect_list(one)).alias("t"))
    return got.select(
        F.col("conv").alias(conv), F.size("t").cast("long").alias("n_turns"),
        F.array_join(F.transform("t", lambda x: x["segment"]), "").alias("formatted"),
        F.array_compact(F.transform("t", lambda x: x["span"])).alias("loss_spans"),
        F.flatten(F.transform("t", lambda x: x["found"])).alias("attachments"),
        F.aggregate(F.flatten(F.transform("t", lambda x: x["found"])), F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("expanded_tokens"),
    )


def parse_chat(formatted: Column, placeholders: bool = True) -> Column:
    """The turns of a formatted string as (role, text), unescaped; placeholders stay in the text, or are left out."""
    marks = "|".join(p.replace("|", r"\|") for p in PLACEHOLDERS.values())
    read = unescape if placeholders else lambda body: F.array_join(F.transform(F.split(body, marks, -1), unescape), "")
    quoted = lambda s: s.replace("|", r"\|")
    parts = F.filter(F.split(formatted, quoted(END), -1), lambda s: s.startswith(TURN))
    return F.transform(parts, lambda s: F.struct(
        unescape(F.substring_index(F.substr(s, F.lit(len(TURN) + 1)), BODY, 1)).alias("role"),
        read(F.substr(s, F.locate(BODY, s) + len(BODY))).alias("text"),
    ))


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped span by span, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
