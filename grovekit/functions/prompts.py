"""Prompt texts, chat messages and the deterministic stand-in predictor."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from grovekit.functions.hashing import md5_modulo

# The prompt texts of the experiments.
BASELINE_SYSTEM = "Answer the question about the image."
DOMAIN_SYSTEM = (
    "You are an expert in digital logic circuits. Answer the question about the "
    "circuit shown in the image.\n"
    "If the answer is a number, respond with only the digit.\n"
    "If the answer is a boolean, respond with only 'True' or 'False'."
)
STEPWISE_SUFFIX = (
    "\nAnalyze the circuit logic step-by-step. "
    "Conclude your reasoning with 'Final Answer: [your answer]'."
)
REVIEW_REQUEST = (
    "Double-check the circuit diagram carefully. Are there any false logic "
    "gate recognitions or miscounted inputs/outputs? Provide a corrected "
    "breakdown and finish with 'Final Answer: [your final answer]'."
)
# The reasoning that the stand-in predictor puts before its answer.
STAND_IN_REASONING = (
    "Looking at the diagram, gate 1 is an OR and gate 2 is a NAND.\n"
    "Node x3 evaluates to True, node 7 evaluates to False.\n"
    "Final Answer: "
)
# Generation limits of the experiments.
SHORT_TOKENS = 16
LONG_TOKENS = 128
VOTE_SAMPLES = 3


def stepwise_prompt(question: Column) -> Column:
    return F.concat(question, F.lit(STEPWISE_SUFFIX))


def review_prompt(question: Column, reasoning: Column, proposed: Column) -> Column:
    """Second-stage prompt; a missing proposal is spelled ``None``."""
    return F.concat(
        F.lit("Question: "), question,
        F.lit("\nInitial Analysis: "), reasoning,
        F.lit("\nProposed Answer: "), F.coalesce(proposed, F.lit("None")),
        F.lit("\n\n" + REVIEW_REQUEST),
    )


def chat_messages(system: Column, user: Column) -> Column:
    """``ARRAY<STRUCT<role, content>>`` with a system and a user turn."""
    return F.array(
        F.struct(F.lit("system").alias("role"), system.alias("content")),
        F.struct(F.lit("user").alias("role"), user.alias("content")),
    )


def stand_in_answer(user: Column, sample: Column | None = None) -> Column:
    """Value chosen by the md5 of the prompt: 0..4 for counts, else True/False.

    ``sample`` numbers the draws of one item; greedy decoding passes none.
    """
    seed = user if sample is None else F.concat(user, F.lit("|"), sample.cast("string"))
    return F.when(
        F.contains(user, F.lit("How many")), md5_modulo(seed, 5).cast("string")
    ).otherwise(F.when(md5_modulo(seed, 2) == 1, F.lit("True")).otherwise(F.lit("False")))


def stand_in_generation(user: Column, sample: Column | None = None) -> Column:
    """Text the stand-in predictor generates for a prompt."""
    wants_reasoning = F.contains(user, F.lit("step-by-step")) | F.contains(
        F.lower(user), F.lit("corrected breakdown")
    )
    value = stand_in_answer(user, sample)
    return F.when(wants_reasoning, F.concat(F.lit(STAND_IN_REASONING), value)).otherwise(value)


def word_count(text: Column) -> Column:
    words = F.filter(F.split(text, r"[\t-\r\x1c-\x20\x{85}\p{Z}]+"), lambda w: w != "")
    return F.size(words)


def stand_in_tokens(raw: Column, max_new_tokens: int) -> Column:
    return F.least(F.lit(max_new_tokens), word_count(raw)).cast("int")
