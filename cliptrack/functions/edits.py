"""Reproducible choice of edits, and the geometry of the zoom edit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cliptrack.functions.values import hashed, hashed_word

# The edits to draw from, and those that change the picture.
EDITS = ("mirror", "zoom", "color", "speed")
WORKING_EDITS = ("mirror", "zoom")
FEWEST_EDITS = 2
ZOOM_MARGIN = 0.05


def edit_count(video_id: Column, seed: int) -> Column:
    """How many edits an item gets: 2, 3 or 4."""
    spread = len(EDITS) - FEWEST_EDITS + 1
    word = hashed_word(video_id, F.lit(str(seed)), F.lit("k"))
    return (F.lit(FEWEST_EDITS) + F.pmod(word, F.lit(spread))).cast("int")


def edit_plan(video_id: Column, seed: int) -> Column:
    """Edits in the order to apply them, drawn without replacement."""
    keyed = F.array(
        *(
            F.struct(
                hashed(video_id, F.lit(str(seed)), F.lit(name)).alias("draw"),
                F.lit(name).alias("name"),
            )
            for name in EDITS
        )
    )
    return F.slice(F.sort_array(keyed)["name"], F.lit(1), edit_count(video_id, seed))


def changes_picture(plan: Column) -> Column:
    """False where only the edits without effect were drawn."""
    return F.arrays_overlap(plan, F.array(*(F.lit(e) for e in WORKING_EDITS)))


def crop_box(width: Column, height: Column) -> Column:
    """Corners left after cutting 5 % from each edge; no size gives zeros."""
    w, h = (F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint")) for c in (width, height))
    left, top = ((c * F.lit(ZOOM_MARGIN)).cast("bigint") for c in (w, h))
    return F.struct(
        left.alias("x1"), top.alias("y1"), (w - left).alias("x2"), (h - top).alias("y2")
    )
