"""Chat formatting with a grammar round trip, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The template's control strings (fixed values).
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
BREAK = "<|nl|>"


def escape(text: Column) -> Column:
    r"""Put one more backslash between ``<`` and ``|``, so that no control string remains."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    r"""Take one backslash away between ``<`` and ``|``."""
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A role ends at the first line break, so breaks inside it become a control string."""
    return F.replace(escape(role), F.lit("\n"), F.lit(BREAK))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(BREAK), F.lit("\n")))


def render(turns: Column) -> Column:
    """One string of ``array<struct<role, text>>`` whose contents are already escaped where needed."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit("\n"), t["text"], F.lit(CLOSE))), "")


def parse(formatted: Column) -> Column:
    """The grammar: turns are OPEN role LF text CLOSE. What does not fit yields a null turn."""
    chunks = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, F.length(formatted) + 1)

    def turn(chunk: Column) -> Column:
        role = F.substring_index(chunk, "\n", 1)
        body = F.substr(chunk, F.length(role) + 2, F.length(chunk) - F.length(role) - 1 - len(CLOSE))
        whole = chunk.endswith(F.lit(CLOSE)) & (F.length(chunk) > F.length(role) + len(CLOSE))
        return F.when(whole, F.struct(unescape_role(role).alias("role"), unescape(body).alias("text")))

    return F.when(F.startswith(formatted, F.lit(OPEN)), F.transform(chunks, turn))


def format_chats(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows (conv_id, turn, role, text)``.

    ``formatted`` is the rendered text, ``turns`` what the parser recovers from it, ``loss``
    the recovered assistant texts in order, ``escaped`` the number of turns that had to be
    escaped. A turn stays as written if it holds no control string and alone survives the round trip; then the whole is
    parsed again, and where it still differs every turn is escaped, which no content can
    break. A whole that differed even then would stop the job.

    Defined results: null role or text counts as empty; a null ``conv_id`` is a conversation
    of its own; rows with equal turn numbers, also repeated rows, are all kept and ordered by
    role and text; a null turn number comes first. An empty table gives an empty result and
    further columns are ignored. A conversation is one value of the result, so its rows meet
    in one task by nature.
    """
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    alone = F.array(F.struct("role", "text"))
    marked = F.rlike(F.concat_ws("\n", "role", "text"), F.lit(r"<\|im_(start|end)\|>"))
    rows = rows.withColumn("safe", F.coalesce(parse(render(alone)) == alone, F.lit(False)) & ~marked)
    rows = rows.withColumns(
        {"shown_role": F.when(F.col("safe"), F.col("role")).otherwise(escape_role(F.col("role"))), "shown": F.when(F.col("safe"), F.col("text")).otherwise(escape(F.col("text")))}
    )
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "shown_role", "shown", "safe"))).alias("rows"))
    source = F.transform("rows", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    sparing = render(F.transform("rows", lambda t: F.struct(t["shown_role"].alias("role"), t["shown"].alias("text"))))
    strict = render(F.transform("rows", lambda t: F.struct(escape_role(t["role"]).alias("role"), escape(t["text"]).alias("text"))))
    chats = chats.select("conv_id", "rows", source.alias("source"), sparing.alias("sparing"))
    fits = F.coalesce(parse(F.col("sparing")) == F.col("source"), F.lit(False))
    chats = chats.withColumn("fits", fits).withColumn("formatted", F.when(F.col("fits"), F.col("sparing")).otherwise(strict))
    chats = chats.withColumn("turns", parse(F.col("formatted")))
    same = F.coalesce(F.col("turns") == F.col("source"), F.lit(False))
    escaped = F.when(F.col("fits"), F.size(F.filter("rows", lambda t: ~t["safe"]))).otherwise(F.size("rows"))
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")
    return chats.select(
        "conv_id",
        F.when(same, F.col("formatted")).otherwise(F.raise_error(F.lit("a conversation differs after the round trip"))).alias("formatted"),
        "turns",
        loss.alias("loss"),
        escaped.cast("long").alias("escaped"),
    )


def loss_spans(formatted: Column) -> Column:
    """``array<struct<start, length>>``: where assistant texts lie in ``formatted``, in characters from 0.

    Lengths are summed as the chunks go by; the array grows by one entry per assistant turn.
    """
    chunks = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, F.length(formatted) + 1)
    head = len(OPEN)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(state: Column, chunk: Column) -> Column:
        role = F.substring_index(chunk, "\n", 1)
        body = (F.length(chunk) - F.length(role) - 1 - len(CLOSE)).cast("long")
        span = F.struct((state["at"] + head + F.length(role) + 1).alias("start"), body.alias("length"))
        spans = F.when(unescape_role(role) == "assistant", F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((state["at"] + head + F.length(chunk)).alias("at"), spans.alias("spans"))

    return F.aggregate(chunks, start, step)["spans"]


def digests(chats: DataFrame) -> DataFrame:
    """Digests and lengths of what was read back."""
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
