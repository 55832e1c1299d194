"""Batch scoring of every client with one model version."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftwise.operators.learners import UpliftModel
from liftwise.operators.rank import sorted_by_score
from liftwise.schemas import KEY, OUTCOME, TREATMENT
from liftwise.session import materialize


def mark_held_out(df: DataFrame, held_out: DataFrame, key: str = KEY) -> DataFrame:
    """Add `split`: 'test' for keys in `held_out`, else 'train'."""
    marks = held_out.select(key, F.lit("test").alias("_mark")).distinct()
    return df.join(marks, key, "left").select(
        *df.columns, F.coalesce("_mark", F.lit("train")).alias("split")
    )


def score_clients(split: DataFrame, model: UpliftModel, key: str = KEY) -> DataFrame:
    """client_id, uplift, treatment, y, split of every client, best first.

    `split` is the labeled table with its split mark, so scores need no join back. They are stored
    before they are sorted: a range sort reads its rows twice and would score them twice.
    """
    scored = model.transform(split).select(key, "uplift", TREATMENT, OUTCOME, "split")
    return sorted_by_score(materialize(scored), "uplift", key)
