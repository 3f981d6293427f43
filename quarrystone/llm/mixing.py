"""Sources mixed to target weights by apportionment of equal-token blocks.

The mix has a number of blocks of equal size in tokens. Sainte-Laguë's rule,
the highest quotients target / (2 k + 1), allots them to sources, no source
above what it may be repeated; the same rule allots a source's blocks to its
shards by their tokens. The last block of a source or shard may be smaller, so
that none is too small to take part. Within a shard, documents lie in a seeded
order cut into blocks; they are taken from its start until the shard's quota is
reached, once more round for every repetition.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrystone.llm.encoding import VOCABULARY, count_tokens
from quarrystone.operators.quantiles import with_running_sum
from quarrystone.session import materialize

BLOCK_TOKENS = 2_048
#: Tokens of a shard, and shards of a source at most (their sizes reach the driver; larger shards are ordered in ranges).
SHARD_TOKENS, MAX_SHARDS = 2_000_000, 4_096


def sainte_lague(weights: np.ndarray, caps: np.ndarray, seats: int) -> np.ndarray:
    """Seats by highest quotients weight / (2 k + 1), none above its cap; ties to the earlier.

    Most seats follow from a divisor found by bisection, the last few one by
    one. Fewer than ``seats`` are given where all caps are reached. Weights of
    0 get none.
    """
    weights, caps = np.asarray(weights, float), np.where(np.asarray(weights) > 0, np.asarray(caps), 0).astype(np.int64)
    seats = int(min(seats, caps.sum()))

    def at(divisor: float) -> np.ndarray:
        return np.minimum(caps, np.floor(np.minimum(weights / divisor + 0.5, 4e18)).astype(np.int64))

    if seats <= 0:
        return np.zeros(len(weights), np.int64)
    # at ``low`` every weight would get all seats, at ``high`` none would get one
    low, high = weights[weights > 0].min() / (seats + 2), 4 * weights.max()
    for _ in range(200):
        middle = np.sqrt(low) * np.sqrt(high)
        if not low < middle < high:
            break
        if at(middle).sum() > seats:
            low = middle
        else:
            high = middle
    given = at(high)
    heap = [(-w / (2 * k + 1), i) for i, (w, k, c) in enumerate(zip(weights, given, caps)) if k < c]
    heapq.heapify(heap)
    for _ in range(seats - int(given.sum())):
        _, i = heapq.heappop(heap)
        given[i] += 1
        if given[i] < caps[i]:
            heapq.heappush(heap, (-weights[i] / (2 * given[i] + 1), i))
    return given


class SourceMix:
    """A mix of ``documents`` towards ``targets`` (source, target_share, max_repeats).

    ``total_tokens`` of the mix, all tokens of the targeted sources unless
    given. Documents of a null or untargeted source, and those without tokens
    (null or empty text), take no part. A target with a null or negative share
    counts as 0, one with a null or negative max_repeats as 0; of a source
    named twice the first by share counts. Targets need not sum to 1. Where a
    target is out of reach, its source is repeated as often as it may be and
    the rest goes to the other sources by their quotients.
    """

    def __init__(self, documents: DataFrame, targets: DataFrame, seed: int = 11, total_tokens: int | None = None, block_tokens: int = BLOCK_TOKENS, vocabulary: str = VOCABULARY):
        self.seed, self.block = seed, block_tokens
        self.targets: dict[str, tuple[float, int]] = {}
        for r in targets.where(F.col("source").isNotNull()).orderBy("source", F.col("target_share").desc()).collect():  # a row per source
            self.targets.setdefault(r["source"], (max(0.0, r["target_share"] or 0.0), max(0, r["max_repeats"] or 0)))
        named = F.col("source").isin(list(self.targets)) if self.targets else F.lit(False)
        counted = count_tokens(documents.where(named).select("doc_id", "source", "text"), ["doc_id", "source"], vocabulary=vocabulary)
        self.tokens = materialize(counted.where(F.col("n_tokens") > 0), "mix-tokens")
        self.available = {r["source"]: r["n"] for r in self.tokens.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
        self.total = sum(self.available.values()) if total_tokens is None else total_tokens
        self.quotas = self._quotas()

    def _quotas(self) -> dict[str, int]:
        names = sorted(self.targets)
        weights = np.array([self.targets[s][0] for s in names])
        caps = np.array([-(-self.targets[s][1] * self.available.get(s, 0) // self.block) for s in names])
        return dict(zip(names, map(int, sainte_lague(weights, caps, -(-self.total // self.block))))) if names else {}

    def _shards(self, source: str) -> int:
        return int(min(MAX_SHARDS, max(1, self.available.get(source, 0) // SHARD_TOKENS)))

    def mixed(self) -> DataFrame:
        """(doc_id, source, n_tokens, copies): every document of the mix, how often it is in it."""
        spark = self.tokens.sparkSession
        empty = "doc_id bigint, source string, n_tokens bigint, copies bigint"
        if not any(self.quotas.values()):
            return spark.createDataFrame([], empty)
        counts = F.create_map(*[x for s in self.available for x in (F.lit(s), F.lit(self._shards(s)))])
        sharded = self.tokens.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(self.seed)), counts[F.col("source")]).cast("int"))
        sizes = sharded.groupBy("source", "shard").agg(F.sum("n_tokens").alias("n")).collect()  # at most MAX_SHARDS rows a source
        rows = []
        for source, quota in self.quotas.items():
            own = sorted((r["shard"], r["n"]) for r in sizes if r["source"] == source)
            n = np.array([x for _, x in own], float)
            repeats = self.targets[source][1]
            rows += [(source, shard, int(q) * self.block, int(size), repeats) for (shard, size), q in zip(own, sainte_lague(n, np.ceil(repeats * n / self.block), quota))]
        quotas = spark.createDataFrame(rows, "source string, shard int, quota bigint, shard_tokens bigint, repeats int")
        ordered = with_running_sum(sharded, ["source", "shard"], [F.xxhash64("doc_id", F.lit(self.seed + 1)), F.col("doc_id")], F.col("n_tokens"))
        placed = ordered.join(F.broadcast(quotas), ["source", "shard"])  # at most MAX_SHARDS rows a source
        rounds = F.expr("quota div shard_tokens")
        rest = F.col("quota") - rounds * F.col("shard_tokens")
        # the document in which the last block ends goes in if most of it lies before that end
        copies = F.least(F.col("repeats").cast("bigint"), rounds + (F.col("before") + F.col("n_tokens") / 2 <= rest).cast("bigint"))
        return placed.select("doc_id", "source", "n_tokens", copies.alias("copies")).where(F.col("copies") > 0)

    def shares(self) -> DataFrame:
        """Per target source: available and mixed tokens, target and actual share, repeats, and whether the cap bound it."""
        spark = self.tokens.sparkSession
        targets = spark.createDataFrame(
            [(s, share, repeats, self.available.get(s, 0), self.quotas.get(s, 0)) for s, (share, repeats) in self.targets.items()],
            "source string, target_share double, max_repeats int, available_tokens bigint, quota_blocks bigint",
        )
        got = self.mixed().groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("mixed_tokens"), F.max("copies").alias("most_copies"), F.count(F.lit(1)).alias("n_documents"))
        joined = targets.join(got, "source", "left").fillna(0, ["mixed_tokens", "most_copies", "n_documents"])
        total = joined.agg(F.sum("mixed_tokens").alias("_all"))
        return joined.join(F.broadcast(total)).select(
            "source", "target_share", F.try_divide("mixed_tokens", "_all").alias("actual_share"), "available_tokens", "mixed_tokens", "n_documents", "max_repeats", "most_copies", "quota_blocks",
            (F.col("quota_blocks") >= F.ceil(F.col("max_repeats") * F.col("available_tokens") / self.block)).alias("capped"),
        )
