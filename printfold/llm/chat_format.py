"""Chat formatting: rebuild conversations from an event log, then render them.

A log row is (conv_id, turn, seq, kind, role, text). Within a message, events apply by ``seq``:

- ``delta`` appends its text,
- ``edit`` replaces all text so far by its own,
- ``regenerate`` drops all text so far (what follows streams anew),
- ``delete`` drops the message, unless later events bring it back.

The role of a message is that of its last event with one.

Template: ``<turn ROLE>\\n`` + text + ``</turn>\\n`` per message. Inside a text a backslash becomes two
and ``<`` becomes ``\\l``, inside a role ``>`` becomes ``\\g`` too, so no control string can occur there and
all steps can be undone.

Defined results: a null text is empty, a null kind is a delta, a null role is ``unknown``; any other
string is a role and is learned from only if it is one of those to learn from, character by character;
null ids form a conversation or turn of their own, nulls first; equal ``seq`` are ordered by kind and text; an empty log gives no rows; other
columns are ignored.

One conversation is one output value, as a chat template needs it; positions are summed by a window
over turns, whose lengths alone are sorted.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KINDS = ("delta", "edit", "regenerate", "delete")
OPEN, SHUT, END = "<turn ", ">\n", "</turn>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    """Undo ``escape``: doubled backslashes part the text, read from the left."""
    return F.array_join(F.transform(F.split(text, r"\\\\", -1), lambda s: F.replace(s, F.lit("\\l"), F.lit("<"))), "\\")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(">"), F.lit("\\g"))


def unescape_role(role: Column) -> Column:
    """Undo ``escape_role``."""
    plain = lambda s: F.replace(F.replace(s, F.lit("\\g"), F.lit(">")), F.lit("\\l"), F.lit("<"))
    return F.array_join(F.transform(F.split(role, r"\\\\", -1), plain), "\\")


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, turn, role, text) of an event log."""
    kind = F.coalesce("kind", F.lit("delta"))
    resets = kind.isin(*KINDS[1:])
    e = events.select("conv_id", "turn", F.struct(
        F.col("seq").alias("seq"), kind.alias("kind"), F.coalesce("text", F.lit("")).alias("text"),
        F.col("role").alias("role"), resets.alias("resets"),
    ).alias("event"))
    folded = e.groupBy("conv_id", "turn").agg(F.sort_array(F.collect_list("event")).alias("log"))
    places = F.transform("log", lambda x, i: F.when(x["resets"], i))
    return (
        folded.withColumn("from", F.coalesce(F.array_max(places), F.lit(0)))
        .withColumn("live", F.slice("log", F.col("from") + 1, F.size("log") - F.col("from")))
        .withColumn("role", _last_role())
        .where((F.col("live")[0]["kind"] != "delete") | (F.size("live") > 1))
        .select("conv_id", "turn", "role", F.array_join(F.transform(
            F.filter("live", lambda x: x["kind"].isin("delta", "edit")), lambda x: x["text"]), "").alias("text"))
    )


def _last_role() -> Column:
    named = F.filter(F.transform("log", lambda x: x["role"]), lambda r: r.isNotNull())
    return F.coalesce(F.get(named, F.size(named) - 1), F.lit("unknown"))


def render(messages: DataFrame, learn=("assistant",)) -> DataFrame:
    """One row per conversation: formatted text, turns, and the loss mask.

    ``loss_spans`` are (start, end) in code points of ``formatted``, end exclusive, one for each
    message of a role in ``learn``.
    """
    role = F.coalesce("role", F.lit("unknown"))
    head, body = F.concat(F.lit(OPEN), escape_role(role), F.lit(SHUT)), escape(F.coalesce("text", F.lit("")))
    turns = messages.select("conv_id", "turn", role.alias("role"), head.alias("head"), body.alias("body"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body").rowsBetween(Window.unboundedPreceding, -1)
    size = F.char_length("head") + F.char_length("body") + len(END)
    placed = turns.withColumn("at", F.coalesce(F.sum(size.cast("long")).over(order), F.lit(0).cast("long")))
    start = F.col("at") + F.char_length("head")
    row = F.struct("at", F.concat("head", "body", F.lit(END)).alias("text"), F.col("role").isin(*learn).alias("learn"),
                   start.alias("start"), (start + F.char_length("body")).alias("end"))
    packed = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    return packed.select(
        "conv_id",
        F.array_join(F.transform("rows", lambda r: r["text"]), "").alias("formatted"),
        F.transform(F.filter("rows", lambda r: r["learn"]),
                    lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"))).alias("loss_spans"),
    )


def read_back(formatted: Column) -> Column:
    """The turns (role, text) that a rendered conversation holds."""
    parts = F.split(formatted, END, -1)
    return F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda p: F.struct(
        unescape_role(F.substr(F.split_part(p, F.lit(SHUT), F.lit(1)), F.lit(len(OPEN) + 1))).alias("role"),
        unescape(F.substr(p, F.char_length(F.split_part(p, F.lit(SHUT), F.lit(1))) + len(SHUT) + 1)).alias("text"),
    ))


def loss_texts(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    return F.transform(spans, lambda s: unescape(
        F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))


def format_log(events: DataFrame, learn=("assistant",)) -> DataFrame:
    """Event log to rendered conversations."""
    return render(fold_events(events), learn)
