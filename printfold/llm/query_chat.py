"""op10: all conversations, sent through the event log, the template and back."""

from pyspark.sql import functions as F

from printfold.llm.chat_format import format_log, loss_texts, read_back

# The extra conversation.
EXTRA = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def as_log(turns):
    """Turns as a log whose rows come late first: a draft, its regeneration, a slip, an edit to half the text, the rest.

    Repeated turns stay apart.
    """
    half = F.floor(F.char_length("text") / 2).cast("int")
    text = turns.select("conv_id", F.struct("turn", "role", "text", "copy").alias("turn"), "role",
                        F.coalesce("text", F.lit("")).alias("text"))
    event = lambda seq, kind, value: F.struct(
        F.lit(seq).alias("seq"), F.lit(kind).alias("kind"), value.alias("text"))
    return text.select("conv_id", "turn", "role", F.explode(F.array(
        event(4, "delta", F.substr("text", half + 1)), event(2, "delta", F.lit("slip")),
        event(0, "delta", F.lit("...")), event(3, "edit", F.substr("text", F.lit(1), half)),
        event(1, "regenerate", F.lit(None).cast("string")))).alias("e")).select("conv_id", "turn", "role", "e.*")


def op10_chat_formatting(spark, folder):
    """Turns and loss texts read back from the rendered conversations."""
    table = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = table.unionByName(spark.createDataFrame(EXTRA, "conv_id long, turn long, role string, text string"))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n")).select(
        "*", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy"))
    chats = format_log(as_log(rows)).withColumn("turns", read_back(F.col("formatted"))).withColumn(
        "loss", F.array_join(loss_texts(F.col("formatted"), F.col("loss_spans")), ""))
    all_turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(all_turns, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


SQL_CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), l AS (
  SELECT *, length('<turn ' || replace(replace(replace(role, '\', '\\'), '<', '\l'), '>', '\g') || '>' || chr(10) || replace(replace(text, '\', '\\'), '<', '\l') || '</turn>' || chr(10)) AS size
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(size)::BIGINT AS formatted_chars
FROM l GROUP BY conv_id
"""
