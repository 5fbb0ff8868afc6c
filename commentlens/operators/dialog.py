"""Conversations and prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from commentlens import rules


def history_trim(df: DataFrame, n: int = rules.HISTORY_MESSAGES) -> DataFrame:
    """The last ``n`` messages of each conversation.

    Spark keeps ``n`` rows per conversation in every task before the shuffle (window group limit),
    so a conversation of any length is never gathered as a whole.
    """
    recent = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    return df.withColumn("_back", F.row_number().over(recent)).filter(F.col("_back") <= n).drop("_back")


def chat_contents(df: DataFrame, n: int = rules.HISTORY_MESSAGES) -> DataFrame:
    """The trimmed history as one array of ``{role, parts: [{text}]}`` per conversation."""
    roles = F.create_map(*[F.lit(x) for pair in rules.CHAT_ROLES.items() for x in pair])
    role = F.coalesce(F.try_element_at(roles, F.col("role")), F.col("role"))
    messages = history_trim(df, n).select(
        "conv_id", F.struct("turn", role.alias("role"), "text").alias("message")
    )
    ordered = F.sort_array(F.collect_list("message"))
    contents = F.transform(
        ordered,
        lambda m: F.struct(
            m["role"].alias("role"),
            F.array(F.struct(m["text"].alias("text"))).alias("parts"),
        ),
    )
    return messages.groupBy("conv_id").agg(contents.alias("contents"))


def build_prompt(context: Column, question: Column) -> Column:
    return F.format_string(rules.PROMPT_TEMPLATE, context, question)
