"""Chat formatting: a dialogue from the perspective of each of its speakers.

For every speaker the whole dialogue is rendered once: this speaker's turns are the
assistant's, all others are users under their names, system turns stay system turns. The
mask lists the character spans that the assistant wrote, each with its end marker; only
there would a loss count.

A dialogue is stored in segments of ``SEGMENT`` turn numbers; joined in order they are the
rendered dialogue. So a conversation of any length is no single group: turns are gathered
per segment, speakers per conversation, and the two are joined. Segments are storage only:
``start`` is the character of the whole dialogue with which a segment begins, and masks count from the
dialogue's beginning. Starts are running sums of lengths, a row per speaker and segment; no text is moved for them.

Defined cases: a null conversation id is a conversation; a null role is the speaker
``unknown``; a null text is empty; a null turn comes first; turns with equal numbers are in
the order of role and text; a conversation without speakers (only system turns) has no
perspective and gives no row; markers inside a text are broken up by a space; repeated
rows are turns of their own; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

SEGMENT = 512
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
SYSTEM, UNKNOWN = "system", "unknown"
RENDERED = "conv_id bigint, perspective string, segment bigint, start bigint, n_turns int, text string, mask array<struct<start:bigint,end:bigint>>"


def render(turns: list[tuple[str, str]], perspective: str) -> tuple[str, list[tuple[int, int]]]:
    """The text of (role, text) turns for one speaker, and the spans it wrote."""
    out, mask, at = [], [], 0
    for role, text in turns:
        name = "assistant" if role == perspective else SYSTEM if role == SYSTEM else f"user name={role}"
        head = f"{OPEN}{name}\n"
        body = f"{text.replace('<|im_', '<| im_')}{CLOSE}\n"
        if role == perspective:
            mask.append((at + len(head), at + len(head) + len(body) - 1))
        out += [head, body]
        at += len(head) + len(body)
    return "".join(out), mask


def segment_starts(rows: DataFrame, speakers: DataFrame) -> DataFrame:
    """(conv, perspective, seg, start): the rendered length of the segments before, from lengths alone."""
    named = F.when(F.col("role") == SYSTEM, F.lit(len(SYSTEM))).otherwise(F.length("role") + len("user name="))
    body = F.length(F.replace("text", F.lit("<|im_"), F.lit("<| im_")))
    frame = len(OPEN) + len(CLOSE) + 2
    # A turn is as long as others see it, but for its own speaker, who stands as the assistant.
    by_role = rows.groupBy("conv_id", "segment", "role").agg(
        F.sum(body + named + frame).alias("seen"), F.sum(F.lit(len("assistant")) - named).alias("own")
    )
    whole = by_role.groupBy(F.col("conv_id").alias("conv"), F.col("segment").alias("seg")).agg(F.sum("seen").alias("seen"))
    right = speakers.withColumnRenamed("conv", "of")
    every = whole.join(right, F.col("conv").eqNullSafe(F.col("of"))).drop("of")
    mine = by_role.select(F.col("conv_id").alias("c"), F.col("segment").alias("s"), F.col("role").alias("r"), "own")
    every = every.join(mine, F.col("conv").eqNullSafe(F.col("c")) & (F.col("seg") == F.col("s")) & (F.col("perspective") == F.col("r")), "left")
    before = Window.partitionBy("conv", "perspective").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    length = F.col("seen") + F.coalesce("own", F.lit(0))
    return every.select("conv", "perspective", "seg", F.coalesce(F.sum(length).over(before), F.lit(0)).cast("bigint").alias("start"))


def perspectives(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation, speaker and segment: the rendered text, where it starts, and its mask."""
    rows = turns.select(
        F.col(f"`{conv_id}`").cast("bigint").alias("conv_id"),
        F.coalesce(F.floor(F.col(f"`{turn}`") / SEGMENT), F.lit(-1)).cast("bigint").alias("segment"),
        F.col(f"`{turn}`").cast("bigint").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(UNKNOWN)).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    speakers = rows.filter(F.col("role") != SYSTEM).select(F.col("conv_id").alias("conv"), F.col("role").alias("perspective")).distinct()
    segments = rows.groupBy("conv_id", "segment").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    starts = segment_starts(rows, speakers)
    both = segments.join(starts, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("segment") == F.col("seg"))).drop("conv", "seg")

    def rotate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [render([(t["role"], t["text"]) for t in turns], who) for turns, who in zip(batch["turns"], batch["perspective"])]
            yield pd.DataFrame({
                "conv_id": batch["conv_id"].astype("Int64"), "perspective": batch["perspective"], "segment": batch["segment"],
                "start": batch["start"], "n_turns": [len(t) for t in batch["turns"]], "text": [text for text, _ in done],
                "mask": [[{"start": at + a, "end": at + b} for a, b in mask] for at, (_, mask) in zip(batch["start"], done)],
            })

    return both.mapInPandas(rotate, RENDERED)
