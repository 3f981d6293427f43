"""What the text outputs and packed files of a job say."""

from __future__ import annotations

import bz2
import gzip
import hashlib
import lzma
import zipfile
from collections.abc import Iterator
from io import BytesIO

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

_STEP = r"Completed ([A-Za-z0-9_]+) in ([0-9.]+) seconds"


def step_seconds(log: Column) -> Column:
    """Map of step to seconds from ``Completed <step> in <s> seconds``; of a step done more than once the last time holds."""
    names, times = F.regexp_extract_all(log, F.lit(_STEP), F.lit(1)), F.regexp_extract_all(log, F.lit(_STEP), F.lit(2))
    pairs = F.filter(F.arrays_zip(names.alias("k"), times.alias("t")), lambda x, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), x["k"]))
    return F.map_from_entries(F.transform(pairs, lambda x: F.struct(x["k"], x["t"].try_cast("double"))))


def backfilled_timings(timings: Column, from_log: Column, steps: list[str]) -> Column:
    """Map of every step to (value, source): the recorded time, else a positive one of the log, else -1.0."""
    def one(step: str) -> Column:
        known, logged = F.try_element_at(timings, F.lit(step)), F.try_element_at(from_log, F.lit(step))
        usable = F.when(logged > 0, logged)
        return F.struct(F.coalesce(known, usable, F.lit(-1.0)).alias("value"), F.when(known.isNotNull(), "recorded").when(usable.isNotNull(), "log").otherwise("none").alias("source"))

    return F.create_map(*[x for s in steps for x in (F.lit(s), one(s))])


def output_is_sound(content: Column, marker: str, banner: str, errors: list[str], head: int = 8192) -> Column:
    """Not empty, no error in the first bytes, the banner at least twice and the marker somewhere."""
    start = F.substring(content, 1, head)
    failed = F.lit(False)
    for e in errors:
        failed = failed | start.contains(e)
    return F.coalesce((F.length(F.trim(content)) > 0) & ~failed & (F.regexp_count(content, F.lit(rf"\Q{banner}\E")) >= 2) & content.contains(marker), F.lit(False))


def last_value(content: Column, pattern: str) -> Column:
    """The first group of the pattern's last match as a number; null without one."""
    return F.try_element_at(F.regexp_extract_all(content, F.lit(pattern), F.lit(1)), F.lit(-1)).try_cast("double")


def _unpacked(name: str, data: bytes) -> str:
    if not data:
        return "empty"
    try:
        if name.endswith(".zip"):
            return "ok" if zipfile.ZipFile(BytesIO(data)).testzip() is None else "broken"
        opened = gzip.decompress(data) if name.endswith(".gz") else bz2.decompress(data) if name.endswith(".bz2") else lzma.decompress(data)
        return "ok" if opened else "empty"
    except Exception:  # noqa: BLE001 - whatever the format's reader raises, the file can't be read
        return "broken"


@F.pandas_udf(StringType())
def packed_status(names: pd.Series, contents: pd.Series) -> pd.Series:
    """``ok``, ``empty`` (no bytes, or nothing inside) or ``broken`` of compressed files by their name's ending."""
    return pd.Series([_unpacked(n or "", c or b"") for n, c in zip(names, contents)], dtype="object")


@F.pandas_udf(LongType())
def salted_rank(values: pd.Series, salts: pd.Series) -> pd.Series:
    """A 64-bit rank of ``salt|value`` by blake2b, as a signed number; meant for distinct values."""
    return pd.Series([int.from_bytes(hashlib.blake2b(f"{s}|{v}".encode(), digest_size=8).digest(), "big", signed=True) for v, s in zip(values, salts)], dtype="int64")


def random_projection(df: DataFrame, vector: str, width: int, to: int, seed: int = 0) -> DataFrame:
    """Vectors of ``width`` numbers projected to ``to`` by a seeded Gaussian matrix; null and other widths give null.

    The matrix is made in each task from the seed, never shipped.
    """
    schema = ", ".join([f"`{n}` {t}" for n, t in df.dtypes if n != vector] + [f"`{vector}` array<float>"])
    keep = [c for c in df.columns if c != vector]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matrix = np.random.default_rng(seed).normal(0, 1 / np.sqrt(to), (width, to)).astype(np.float32)
        for frame in frames:
            good = [v is not None and len(v) == width for v in frame[vector]]
            out = pd.Series([None] * len(frame), dtype="object")
            if any(good):
                stacked = np.stack([np.asarray(v, np.float32) for v, g in zip(frame[vector], good) if g]) @ matrix
                out[np.flatnonzero(good)] = list(stacked)
            yield frame[keep].assign(**{vector: out.to_numpy()})

    return df.mapInPandas(run, schema)
