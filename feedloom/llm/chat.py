"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns are its context, and
only its reply is trainable. Turns after the last reply make one more example without a
trainable part, so that no turn is lost.

Template: ``<|im_start|>`` role ``\\n`` text ``<|im_end|>\\n``. Control strings inside roles and
texts get a backslash after their first character and backslashes are doubled, which
``unescape`` reverts; a line break in a role is escaped as well.

Defined cases: a null text or role is empty; turns are ordered by turn (null last), role and
text, so ties and repeated rows have a fixed place and are kept; a null ``conv_id`` is a
conversation of its own; an empty table gives an empty result; further columns are ignored.
An example holds its whole context, so the output of one conversation grows with the square
of its turns: that is the format, nothing is cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.llm.inputs import table
from feedloom.session import materialize

BEGIN, END = "<|im_start|>", "<|im_end|>\n"
CONTROLS = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
NO_ROWS = "conv_id long, turn long, role string, text string"


def escape(text: Column) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for control in CONTROLS:
        out = F.replace(out, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}"))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_examples(turns: DataFrame) -> DataFrame:
    """One row per example: conv_id, example_no, formatted, loss_start, loss_end.

    ``loss_start`` and ``loss_end`` count characters of ``formatted`` from 0, the end excluded.
    """
    role = F.coalesce(F.col("role"), F.lit(""))
    key = [F.col("turn").asc_nulls_last(), role, F.coalesce(F.col("text"), F.lit(""))]
    whole = Window.partitionBy("conv_id").orderBy(*key)
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    head = F.concat(F.lit(BEGIN), F.replace(escape(role), F.lit("\n"), F.lit("\\\n")), F.lit("\n"))
    numbered = turns.select("conv_id", "turn", "role", "text").select(
        "conv_id",
        F.row_number().over(whole).alias("example_no"),
        (role == "assistant").alias("reply"),
        F.lead(F.lit(1)).over(whole).isNull().alias("last"),
        F.collect_list(F.concat(head, escape(F.col("text")), F.lit(END))).over(before).alias("context"),
        head.alias("head"),
        escape(F.col("text")).alias("body"),
    )
    prompt = F.concat(F.array_join("context", ""), F.col("head"))
    length = F.when(F.col("reply"), F.char_length("body")).otherwise(0)
    return (
        numbered.where(F.col("reply") | F.col("last"))
        .select("conv_id", "example_no", prompt.alias("prompt"), "body", length.alias("loss_chars"))
        .select(
            "conv_id",
            "example_no",
            F.concat("prompt", "body", F.lit(END)).alias("formatted"),
            F.char_length("prompt").alias("loss_start"),
            (F.char_length("prompt") + F.col("loss_chars")).alias("loss_end"),
        )
    )


def loss_text(examples: DataFrame) -> Column:
    """The trainable text of an example as it was before escaping."""
    start, end = examples["loss_start"], examples["loss_end"]
    return unescape(F.substring(examples["formatted"], start + 1, end - start))


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted text, each as role, line break, text, line break."""
    parts = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda part: part != "")
    return F.transform(parts, lambda part: F.concat(unescape(F.substr(part, F.lit(len(BEGIN) + 1))), F.lit("\n")))


def conversation_digests(examples: DataFrame) -> DataFrame:
    """Read the examples back: what they hold of each conversation."""
    one = examples.select(
        "conv_id",
        "example_no",
        F.char_length("formatted").cast("long").alias("chars"),
        F.struct("example_no", loss_text(examples).alias("text")).alias("loss"),
        F.struct("example_no", "formatted").alias("longest"),
    )
    loss = F.array_join(F.transform(F.array_sort("losses"), lambda x: x["text"]), "")
    turns = parse_turns(F.col("longest.formatted"))
    return (
        one.groupBy("conv_id")
        .agg(
            F.collect_list("loss").alias("losses"),
            F.max("longest").alias("longest"),
            F.sum("chars").alias("formatted_chars"),
        )
        .select("conv_id", "formatted_chars", turns.alias("turns"), loss.alias("loss"))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
            F.char_length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )


PROBE = "</s>[INST] ok [/INST]"


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the probe conversation -1, formatted, written and read back."""
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], NO_ROWS)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return conversation_digests(materialize(format_examples(turns), "chat-examples"))


def _escaped_sql(column: str) -> str:
    out = f"replace({column}, chr(92), chr(92) || chr(92))"
    for control in CONTROLS:
        out = f"replace({out}, '{control}', '{control[0]}' || chr(92) || '{control[1:]}')"
    return out


OP8_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'
), sized AS (
  SELECT *, row_number() OVER w AS no, lead(1) OVER w IS NULL AS is_last,
    sum({len(BEGIN) + 1 + len(END)} + length(replace({_escaped_sql("role")}, chr(10), chr(92) || chr(10)))
        + length({_escaped_sql("text")})) OVER w AS upto
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), grouped AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY no) AS all_turns,
    coalesce(string_agg(text, '' ORDER BY no) FILTER (role = 'assistant'), '') AS loss,
    CAST(sum(upto) FILTER (role = 'assistant' OR is_last) AS BIGINT) AS formatted_chars
  FROM sized GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(all_turns) AS turns_sha256, length(loss) AS loss_chars,
  sha256(loss) AS loss_sha256, formatted_chars
FROM grouped
"""
