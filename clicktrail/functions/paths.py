"""Facts read off delivered file paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words in old file names that tell the delivery phase, in test order.
PHASE_WORDS = (
    ("phase1", ("phase1", "crawl")),
    ("phase2", ("phase2", "walk")),
    ("phase3", ("phase3", "jog")),
    ("phase4", ("phase4", "run")),
    ("phase5", ("phase5", "sprint")),
)
NAME_TIMESTAMP = r"_[0-9]{8}_[0-9]{6}\."


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def is_hit_file(path: Column) -> Column:
    return F.lower(path).endswith(".tab")


def has_name_timestamp(name: Column) -> Column:
    """The naming contract: ``_YYYYMMDD_HHMMSS.`` somewhere in the file name."""
    return name.rlike(NAME_TIMESTAMP)


def phase_label(key: Column) -> Column:
    """Delivery phase of an object key: its own path part, else a word in the key."""
    folder = F.regexp_extract(F.concat(F.lit("/"), key, F.lit("/")), "/(phase[0-9]+)/", 1)
    lowered = F.lower(key)
    label = F.when(folder != "", folder)
    for phase, words in PHASE_WORDS:
        label = label.when(lowered.rlike("|".join(words)), F.lit(phase))
    return label.otherwise(F.lit("other"))
