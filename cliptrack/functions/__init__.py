from cliptrack.functions.backoff import Backoff, after_seconds
from cliptrack.functions.edits import changes_picture, crop_box, edit_count, edit_plan
from cliptrack.functions.order import queue_key, queue_sort
from cliptrack.functions.paths import (
    below,
    file_name,
    file_stem,
    file_suffix,
    is_partial,
    output_path,
)
from cliptrack.functions.values import filled, hashed_uniform, is_filled, whole_seconds

__all__ = [
    "Backoff",
    "after_seconds",
    "below",
    "changes_picture",
    "crop_box",
    "edit_count",
    "edit_plan",
    "file_name",
    "file_stem",
    "file_suffix",
    "filled",
    "hashed_uniform",
    "is_filled",
    "is_partial",
    "output_path",
    "queue_key",
    "queue_sort",
    "whole_seconds",
]
