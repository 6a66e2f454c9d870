"""Mixing sources to target weights.

The words of a source are packed into blocks of a fixed length. The mix is a number of output shards; each
shard draws how many blocks it takes from each source, multinomially, so that the shards' draws add up to
the source's target. The slots a source has drawn are numbered over all shards, and slot ``j`` takes the
block that a pseudorandom permutation of the source's block indices gives for ``j mod blocks`` (another
permutation for each round through the source). Slots and blocks meet in a join on the block's index.

Sizes are words. Sources sort by code point, null last, and weigh 5, 2, 1, repeating; a target stops at
``most`` times the size of its source, and the excess is shared by weight among the rest until none is above.

Everything is a function of the table and ``seed``. Word positions within a source come from running sums
over hash buckets, so a source with a third of all rows is no single task. One row per source is
brought to the driver: that is the mixing recipe, which somebody writes down per source.

Defined cases: null and empty texts have size 0 and are never taken. A source without words has target 0.
Repeated rows (also with equal or null ``doc_id``) are documents of their own. An empty table gives an empty
table. Other columns stay where ``mixed_documents`` returns documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickspark.llm.common import WORD, fitting_name, map_batches, stored
from tickspark.llm.spread import spread_join

WEIGHTS = (5.0, 2.0, 1.0)
ROWS_PER_BUCKET = 20_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("bigint"), F.lit(0))


def targets(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size (as far as the sizes allow)."""
    caps, out = [most * s for s in sizes], [0.0] * len(sizes)
    open_, rest = {i for i, s in enumerate(sizes) if s}, min(total, float(sum(caps)))
    while open_:
        unit = rest / sum(weights[i] for i in open_)
        full = [i for i in open_ if unit * weights[i] >= caps[i]]
        for i in full or open_:
            out[i] = float(caps[i]) if full else unit * weights[i]
        if not full:
            break
        rest -= sum(caps[i] for i in full)
        open_ -= set(full)
    return out


def permuted(index: np.ndarray, n: int, key: int, back: bool = False) -> np.ndarray:
    """A pseudorandom permutation of range(n) at ``index``, or its inverse: a Feistel network that walks
    on while it is outside the range."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.random.default_rng(key).integers(0, 2**63, 6, dtype=np.int64).astype(np.uint64)

    def f(x: np.ndarray, k: np.uint64) -> np.ndarray:
        x = (x ^ k) * np.uint64(0x9E3779B97F4A7C15)
        return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(20)) & mask

    def once(x: np.ndarray) -> np.ndarray:
        a, b = x >> np.uint64(half), x & mask
        for k in keys[::-1] if back else keys:
            a, b = (b ^ f(a, k), a) if back else (b, a ^ f(b, k))
        return a << np.uint64(half) | b

    x = once(np.asarray(index, np.uint64))
    while (out := x >= np.uint64(n)).any():
        x[out] = once(x[out])
    return x.astype(np.int64)


def plan_mix(docs: DataFrame, share: float = 1.5, most: float = 2.0, block: int = 512, seed: int = 0,
             source: str = "source", text: str = "text", keep: list[str] | None = None) -> "Mix":
    """Measure the sources, set targets and place every document in its source's stream of words."""
    cols = keep or [c for c in docs.columns if c != text]
    return _plan(stored(docs.select(*[F.col(f"`{c}`") for c in cols], F.col(source).alias("_source"),
                                    word_count(F.col(text)).alias("_size"), F.xxhash64(text).alias("_hash")), "sizes"), cols, share, most, block, seed)


def _plan(sized: DataFrame, cols: list[str], share: float = 1.5, most: float = 2.0, block: int = 512, seed: int = 0) -> "Mix":
    """The mix of rows with ``_source``, ``_size`` and ``_hash``; ``cols`` name a row."""
    found = sized.groupBy("_source").agg(F.sum("_size"), F.count("*")).collect()
    # Spark compares strings by UTF-8 bytes, which is the order of code points; so does Python.
    found.sort(key=lambda r: (r[0] is None, r[0] or ""))
    sizes = [r[1] or 0 for r in found]
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(found))]
    wanted = targets(sizes, weights, share * sum(sizes), most)
    recipe = []
    for i, (r, size, want) in enumerate(zip(found, sizes, wanted)):
        length = max(1, min(block, size // 256))  # short enough to come near the target of a small source
        n = -(-size // length)
        draws = min(round(want / size * n), int(most * n)) if size else 0
        recipe.append((i, r[0], int(size), float(want), length, n, draws))
    sources = sized.sparkSession.createDataFrame(recipe, "sid int, src string, source_size bigint, target double, length bigint, "
                                              "blocks bigint, draws bigint")
    buckets = max(64, sum(r[2] for r in found) // ROWS_PER_BUCKET)
    placed = sized.join(F.broadcast(sources) if len(recipe) <= 10_000 else sources, F.col("_source").eqNullSafe(F.col("src")))
    placed = placed.withColumn("_bucket", F.pmod(F.xxhash64("_hash", *_orderable(sized, cols)), F.lit(buckets)))
    order = Window.partitionBy("sid", "_bucket").orderBy("_hash", *_orderable(sized, cols))
    before = Window.partitionBy("sid").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("sid", "_bucket").agg(F.sum("_size").alias("_n")).select(
        "sid", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = placed.withColumn("_at", F.coalesce(F.sum("_size").over(
        order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = inside.join(totals, ["sid", "_bucket"]).withColumn("_at", F.col("_at") + F.col("_before"))
    return Mix(stored(placed.drop("_bucket", "_before", "_hash", "src"), "placed"), sources, cols, seed, block)


def _orderable(df: DataFrame, cols: list[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in cols if not dict(df.dtypes)[c].startswith(("map", "variant"))]


class Mix:
    """A planned mix: ``slots`` of every output shard and what they take of each document."""

    def __init__(self, placed: DataFrame, sources: DataFrame, cols: list[str], seed: int, block: int):
        self.placed, self.sources, self.cols, self.seed = placed, sources, cols, seed
        self._slots: DataFrame | None = None

    def slots(self, per_shard: int = 4096) -> DataFrame:
        """``shard``, ``slot``, ``round``, ``sid``, ``block_index``: which block stands where in the mix."""
        if self._slots is not None:
            return self._slots
        rows = self.sources.select("sid", "blocks", "draws").collect()
        total = sum(r.draws for r in rows)
        shards = max(1, min(4096, -(-total // per_shard)))
        counts = shard_draws([r.draws for r in rows], shards, self.seed)
        starts = np.cumsum(counts, axis=0) - counts
        runs = [(s, int(r.sid), int(starts[s, i]), int(counts[s, i]), int(r.blocks))
                for i, r in enumerate(rows) for s in range(shards) if counts[s, i]]
        frame = self.sources.sparkSession.createDataFrame(runs, "shard int, sid int, first bigint, n bigint, blocks bigint")
        pieces = frame.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(65_536))).alias("at")).select(
            "shard", "sid", (F.col("first") + F.col("at")).alias("first"),
            F.least(F.col("n") - F.col("at"), F.lit(65_536)).alias("n"), "blocks")
        seed = self.seed

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in batch.to_pylist():
                    j = np.arange(r["first"], r["first"] + r["n"])
                    rounds, index = j // r["blocks"], j % r["blocks"]
                    block = np.empty_like(index)
                    for k in np.unique(rounds):
                        here = rounds == k
                        block[here] = permuted(index[here], r["blocks"], _key(seed, r["sid"], int(k)))
                    yield pa.RecordBatch.from_pydict({
                        "shard": np.full(len(j), r["shard"], np.int32), "slot": j, "round": rounds.astype(np.int32),
                        "sid": np.full(len(j), r["sid"], np.int32), "block_index": block})

        self._slots = stored(map_batches(pieces.repartition(max(1, -(-total // 65_536))), run,
                                         "shard int, slot bigint, round int, sid int, block_index bigint"), "slots")
        return self._slots

    def parts(self) -> DataFrame:
        """Every part of a document that lies in one block, once for each time it is taken.

        ``sid``, ``_at`` (which name the document), ``round``, ``shard``, ``slot``, ``first`` and ``words``: the
        part's place in the document and its length.
        """
        end = F.col("_at") + F.col("_size")
        pieces = self.placed.where("_size > 0").select(
            "sid", "_at", "_size", "length",
            F.explode(F.sequence(F.floor(F.col("_at") / F.col("length")), F.floor((end - 1) / F.col("length")))).alias("block_index"))
        lo = F.greatest(F.col("_at"), F.col("block_index") * F.col("length"))
        hi = F.least(F.col("_at") + F.col("_size"), (F.col("block_index") + 1) * F.col("length"))
        pieces = pieces.select("sid", "_at", "block_index", (lo - F.col("_at")).alias("first"), (hi - lo).alias("words"))
        return pieces.join(self.slots(), ["sid", "block_index"])

    def taken(self) -> DataFrame:
        """Every document with ``size``, ``source_size``, ``target`` and ``taken``, the words the mix has of it."""
        sums = self.parts().groupBy("sid", "_at").agg(F.sum("words").alias("_taken"))
        full = self.placed.where("_size > 0").join(sums, ["sid", "_at"], "left")
        rest = self.placed.where("_size = 0").withColumn("_taken", F.lit(None).cast("bigint"))
        return full.unionByName(rest).select(
            *self.cols, F.col("_size").alias("size"), "source_size", "target", F.coalesce("_taken", F.lit(0)).alias("taken"))


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: a row for each round in which words of a document are taken.

    A document taken whole keeps its text; of others the taken stretches are left, one to a line. Rows with equal
    key, source and text are as many documents, counted beforehand; what their other columns hold is taken from one of them.
    """
    empty, number, hashed, nowhere, origin, copy, cuts = (fitting_name(docs, c) for c in (
        "key_null", "key_text", "text_hash", "source_null", "source_text", "copy", "cuts"))
    source = options.pop("source", "source")
    named = docs.withColumns({
        empty: F.col(key).isNull(), number: F.coalesce(F.col(key).cast("string"), F.lit("")), hashed: F.xxhash64(text),
        nowhere: F.col(source).isNull(), origin: F.coalesce(F.col(source).cast("string"), F.lit(""))})
    ids = [empty, number, hashed, nowhere, origin]
    counted = stored(named.groupBy(*ids).agg(F.count("*").alias("_copies"), F.max(word_count(F.col(text))).alias("_size")), "copies")
    sized = counted.select(*ids, F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies")).alias(copy), "_size",
                           F.when(~F.col(nowhere), F.col(origin)).alias("_source"), F.col(hashed).alias("_hash"))
    mix = _plan(sized, [*ids, copy], **options)
    stretches = mix.parts().groupBy("sid", "_at", "round").agg(
        F.sort_array(F.collect_list(F.struct("first", "words"))).alias(cuts))
    wanted = stored(mix.placed.where("_size > 0").select("sid", "_at", "_size", *ids, copy).join(stretches, ["sid", "_at"]).select(
        *ids, copy, F.when(F.aggregate(cuts, F.lit(0).cast("bigint"), lambda a, c: a + c["words"]) < F.col("_size"), F.col(cuts)).alias(cuts)), "taken")
    if counted.where("_copies > 1").isEmpty():
        chosen = named.join(wanted, ids)
    else:  # one of the equal rows lends its text to what is taken of all of them
        chosen = spread_join(wanted, named.dropDuplicates(ids), ids, copy)
    chosen = chosen.select(*docs.columns, cuts)
    place = docs.columns.index(text)
    word = re.compile(WORD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for t, parts in zip(batch.column(place).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                if parts is not None:
                    spans = [m.span() for m in word.finditer(t)]
                    joined: list[list[int]] = []
                    for p in parts:
                        if joined and joined[-1][1] == p["first"]:
                            joined[-1][1] += p["words"]
                        else:
                            joined.append([p["first"], p["first"] + p["words"]])
                    t = "\n".join(t[spans[a][0]: spans[b - 1][1]] for a, b in joined)
                texts.append(t)
            columns = batch.columns[:-1]
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    return map_batches(chosen, run, docs.schema)


def _key(seed: int, sid: int, round_: int) -> list[int]:
    return [seed, sid, round_]


def shard_draws(draws: list[int], shards: int, seed: int) -> np.ndarray:
    """For each shard how many blocks it takes of each source: multinomial draws from what is left of the sources."""
    rng, left = np.random.default_rng([seed, 1]), np.array(draws, np.int64)
    out = np.zeros((shards, len(draws)), np.int64)
    for s in range(shards):
        rest = int(left.sum())
        n = rest // (shards - s)
        if s == shards - 1:
            take = left.copy()
        else:
            take = np.zeros_like(left)
            while n:  # what a source lacks is drawn again from the others
                more = np.minimum(rng.multinomial(n, (left - take) / (left - take).sum()), left - take)
                take += more
                n -= int(more.sum())
        out[s] = take
        left -= take
    return out
