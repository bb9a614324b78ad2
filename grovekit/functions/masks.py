"""Loss masks over token arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: label of tokens that the loss ignores.
IGNORED = -100


def first_occurrence(tokens: Column, marker: Column) -> Column:
    """1-based start of the first occurrence of ``marker``; 0 when absent."""
    last = F.size(tokens) - F.size(marker) + 1
    starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    # The first-token test keeps the slice off all but a few positions.
    hits = F.filter(
        starts,
        lambda i: (F.get(tokens, i - 1) == F.get(marker, F.lit(0)))
        & (F.slice(tokens, i, F.size(marker)) == marker),
    )
    return F.coalesce(F.get(hits, F.lit(0)), F.lit(0))


def loss_labels(tokens: Column, marker: Column, pad: Column, start: Column | None = None) -> Column:
    """Tokens with the prompt (through the marker) and padding set to -100."""
    start = first_occurrence(tokens, marker) if start is None else start
    prompt_end = F.when(start > 0, start + F.size(marker) - 1).otherwise(F.lit(0))
    return F.transform(
        tokens,
        lambda t, i: F.when((i < prompt_end) | (t == pad), F.lit(IGNORED)).otherwise(t),
    )
