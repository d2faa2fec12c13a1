"""Transcripts of an agent: history, actions, answers, outcomes; judging and grading."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shapla.functions.text import tokens, trim_ws
from shapla.session import materialize

# Markers of answers and refusals, tool names, the pattern of an action.
ANSWER_MARK, FINAL_MARK, REFUSAL = "**উত্তর:**", "Final Answer:", "দুঃখিত, সরকারি নীতিমালার আওতায়"
ACTION = r"Action:\s*(\w+)\(['\"]?([^\n]*?)['\"]?\)"
STRICT_FINAL, LOOSE_FINAL = r"(?i)\**Final Answer:\**|\**উত্তর:\**", r"(?i)\**final answer:?\**|\**উত্তর:\**"
TREE_TOOLS = ["search_tree", "search", "hybrid_search"]
SEARCH_TOOLS = ["hybrid_search", "vector_search", "search", "exact_keyword_search", "lexical_search"]
LOOP_ERROR = "Agent Loop Error"


def last_turns(turns: DataFrame, n: int = 6) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    return turns.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def history(turns: DataFrame, n: int = 6) -> DataFrame:
    """The last n turns; of an assistant's only the answer after its last marker; turns left empty are dropped."""
    t = F.col("text")
    answer = F.when(t.contains(ANSWER_MARK), F.substring_index(t, ANSWER_MARK, -1)).when(t.contains(FINAL_MARK), F.substring_index(t, FINAL_MARK, -1)).otherwise(t)
    said = F.when(F.col("role") == "assistant", trim_ws(answer)).otherwise(t)
    return last_turns(turns, n).withColumn("text", said).where("text <> ''")


def actions(turns: DataFrame) -> DataFrame:
    """Turns with the tool, query and whole text of their first action; empty strings where there is none."""
    t = F.col("text")
    return turns.withColumn("tool", F.regexp_extract(t, ACTION, 1)).withColumn("query", F.regexp_extract(t, ACTION, 2)).withColumn("action", F.lower(F.regexp_extract(t, ACTION, 0)))


def final_answer(text: Column, strict: bool = True) -> Column:
    """The part after the last answer marker, trimmed; NULL without one."""
    pattern = STRICT_FINAL if strict else LOOSE_FINAL
    return F.when(text.rlike(pattern), trim_ws(F.element_at(F.split(text, pattern), -1)))


def outcome(turns: DataFrame, tools: list[str] = TREE_TOOLS, strict: bool = True) -> DataFrame:
    """Turns with their outcome: guardrail, final, repeated, search, no_tool, unknown_tool or format_error, in this order."""
    a = actions(turns)
    w = Window.partitionBy("conv_id", "action").orderBy("turn")
    a = a.withColumn("repeated", (F.col("action") != "") & (F.row_number().over(w) > 1))
    o = (
        F.when(F.col("text").contains(REFUSAL), "guardrail").when(F.col("text").rlike(STRICT_FINAL if strict else LOOSE_FINAL), "final")
        .when(F.col("action") == "", "format_error").when(F.col("repeated"), "repeated").when(F.col("tool").isin(tools), "search").when(F.col("tool") == "no_tool_needed", "no_tool").otherwise("unknown_tool")
    )
    return a.withColumn("outcome", o)


class Judge(Protocol):
    """Compares two answers; the default takes the one that shares more of its words with the question."""

    def compare(self, query: Column, a: Column, b: Column) -> Column: ...


class OverlapJudge:
    def compare(self, query: Column, a: Column, b: Column) -> Column:
        x, y = overlap(a, query), overlap(b, query)
        return F.when(x > y, "A").when(y > x, "B").otherwise("Tie")


def overlap(answer: Column, reference: Column) -> Column:
    """Share of the reference's distinct words that the answer has; a stand-in for a graded metric."""
    r = F.array_distinct(tokens(reference))
    return F.coalesce(F.try_divide(F.size(F.array_intersect(r, F.array_distinct(tokens(answer)))), F.size(r)), F.lit(0.0))


def judge(rows: DataFrame, by: Judge | None = None) -> DataFrame:
    """`rows` (query, answer_a, answer_b) with winner; two failed loops are a tie without any call.

    A judge that gives no verdict, or one that starts with an error, is a `Judge Error`.
    """
    q, a, b = F.col("query"), F.coalesce("answer_a", F.lit("")), F.coalesce("answer_b", F.lit(""))
    failed = a.contains(LOOP_ERROR) & b.contains(LOOP_ERROR)
    said = (by or OverlapJudge()).compare(q, a, b)
    verdict = F.when(said.isNull(), "Judge Error: no verdict").when(said.isin("A", "B", "Tie"), said).otherwise(F.concat(F.lit("Judge Error: "), said))
    return rows.withColumn("winner", F.when(failed, "Tie (Both Failed)").otherwise(verdict))


#: Lexical stand-ins for graded metrics: (answer, reference, query) -> score from 0 to 1, or NULL where it can't be had.
METRICS = {
    "relevancy": lambda answer, reference, query: overlap(answer, query),
    "recall": lambda answer, reference, query: F.when(reference.isNotNull(), overlap(answer, reference)),
    "precision": lambda answer, reference, query: F.when(reference.isNotNull(), overlap(reference, answer)),
}


def grade(rows: DataFrame, systems: list[str], metrics: dict | None = None, threshold: float = 0.7) -> DataFrame:
    """`rows` (queries, expected_answer, sys_X_actual_answer) with score, passed and error of each metric and system.

    Where there is no score the error column says `JSON_Error`, and passed is null.
    """
    for name in systems:
        answer = F.col(f"sys_{name}_actual_answer")
        for metric, score in (metrics or METRICS).items():
            s = F.when(answer.isNotNull(), score(answer, F.col("expected_answer"), F.col("queries")))
            c = f"sys_{name}_{metric}"
            rows = rows.withColumn(f"{c}_score", s).withColumn(f"{c}_passed", F.col(f"{c}_score") >= threshold).withColumn(f"{c}_error", F.when(F.col(f"{c}_score").isNull(), "JSON_Error"))
    return rows


def run_systems(items: DataFrame, systems: dict[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """`items` (item_id, queries, expected_answer) with each system's answer; a system maps (query, text) to (query, answer).

    A query without an answer keeps its row with a null.
    """
    asked = items.select(F.col("item_id").alias("query"), F.col("queries").alias("text"))
    for name, answer in systems.items():
        a = materialize(answer(asked).select(F.col("query").alias("item_id"), F.col("answer").alias(f"sys_{name}_actual_answer")))
        items = items.join(a, "item_id", "left")
    return items


#: What an agent is told after each kind of turn.
TOLD = {
    "repeated": "This search has been made before. Search with other words, or close with 'Final Answer:' and say that nothing is known.",
    "no_tool": "Nothing needs to be searched. Answer now.",
    "nothing": "Nothing was found for this query. Search with other words.",
    "format_error": "A turn must hold 'Action: tool(\"query\")' or 'Final Answer:'.",
}
OBSERVED = "Observation: {0}\n\nClose with 'Final Answer:' if this answers the question; else use another Action."
ROUNDS = 15


def run_agent(questions: DataFrame, reply: Callable[[DataFrame], DataFrame], search: Callable[[DataFrame], DataFrame], rounds: int = ROUNDS, tools: list[str] = SEARCH_TOOLS) -> DataFrame:
    """(conv_id, answer, outcome, turns) of a loop of model turns and searches for all questions (conv_id, text) at once.

    `reply` maps the open conversations (conv_id, turns) to (conv_id, text), `search` maps (query, text) to (query, context); both
    are calls for a whole batch. A conversation ends with a refusal, a final answer, a missing reply (`loop_error`), or
    after `rounds` turns (`exhausted`). Each round is written out, so a lost executor repeats one round.
    """
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("text"))
    open_ = materialize(questions.select("conv_id", F.array(turn("user", F.col("text"))).alias("turns"), F.array().cast("array<string>").alias("tried")))
    ended = []
    for _ in range(rounds):
        if open_.isEmpty():
            break
        said = actions(open_.join(reply(open_.select("conv_id", "turns")), "conv_id", "left"))
        text = F.col("text")
        kind = (
            F.when(text.isNull(), "loop_error").when(text.contains(REFUSAL), "guardrail").when(text.rlike(STRICT_FINAL), "final").when(F.col("action") == "", "format_error")
            .when(F.array_contains("tried", F.col("action")), "repeated").when(F.col("tool").isin(tools), "search").when(F.col("tool") == "no_tool_needed", "no_tool").otherwise("unknown_tool")
        )
        said = materialize(said.withColumn("outcome", kind))
        over = F.col("outcome").isin("loop_error", "guardrail", "final")
        answer = F.when(F.col("outcome") == "final", final_answer(text)).when(F.col("outcome") == "guardrail", text).otherwise(F.lit(LOOP_ERROR))
        ended.append(said.where(over).select("conv_id", answer.alias("answer"), "outcome", F.when(text.isNull(), F.col("turns")).otherwise(F.concat("turns", F.array(turn("assistant", text)))).alias("turns")))
        seen = search(said.where("outcome = 'search'").select(F.col("conv_id").alias("query"), F.col("query").alias("text"))).select(F.col("query").alias("conv_id"), "context")
        told = F.when(F.col("outcome") == "search", F.when(trim_ws(F.coalesce("context", F.lit(""))) == "", TOLD["nothing"]).otherwise(F.col("context")))
        told = told.when(F.col("outcome") == "unknown_tool", F.concat(F.lit("Error: Tool '"), "tool", F.lit("' not recognized."))).when(F.col("outcome") == "no_tool", TOLD["no_tool"]).otherwise(TOLD["repeated"])
        before, after = OBSERVED.split("{0}")
        back = F.when(F.col("outcome") == "format_error", TOLD["format_error"]).otherwise(F.concat(F.lit(before), told, F.lit(after)))
        go_on = said.where(~over).join(seen, "conv_id", "left")
        open_ = materialize(go_on.select("conv_id", F.concat("turns", F.array(turn("assistant", text), turn("user", back))).alias("turns"), F.when(F.col("action") == "", F.col("tried")).otherwise(F.array_union("tried", F.array("action"))).alias("tried")))
    ended.append(open_.select("conv_id", F.lit(None).cast("string").alias("answer"), F.lit("exhausted").alias("outcome"), "turns"))
    return reduce(DataFrame.unionByName, ended)
