"""Mixing sources to target weights: whole passes, then a subset of documents whose lengths fit what is left of the budget."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.llm.common import Scratch, numbered, table

WEIGHTS = (3, 1, 2)      # of the sources in code point order, over and over
SHARE = 150              # percent of all words that the mix takes
MOST = 2                 # times a document may be taken
SEED = 7
SUMS = 1 << 17           # budgets below this are fitted by dynamic programming
CHUNK_ROWS = 20_000      # documents of one length ranked in one group, about
BROADCAST_ROWS = 100_000
WORD = r"[^\x20\x09-\x0D]+"


def fit_sum(lengths: Sequence[int], counts: Sequence[int], budget: int) -> list[int]:
    """How many of each length give the largest sum up to ``budget``: a bounded knapsack in which weight and value agree.

    Counts are split into powers of two, so a length makes a logarithmic number of items; ``by`` holds the first item with which a sum was
    reached, which leads back from the best sum. It ends as soon as the budget itself is reached. Memory and time per item follow the budget.
    """
    by = np.full(budget + 1, -1, np.int64)
    items, reached = [], np.zeros(budget + 1, bool)
    reached[0] = True
    for place, (length, count) in enumerate(zip(lengths, counts, strict=True)):
        count = min(count, budget // length) if length > 0 else 0
        size = 1
        while count and not reached[budget]:
            take = min(size, count)
            step = take * length
            new = reached[:-step] & ~reached[step:]
            by[step:][new] = len(items)
            reached[step:] |= new
            items.append((place, take, step))
            count, size = count - take, size * 2
    out = [0] * len(lengths)
    at = int(np.flatnonzero(reached)[-1])
    while at:
        place, take, step = items[by[at]]
        out[place] += take
        at -= step
    return out


def fit_budget(sizes: np.ndarray, counts: np.ndarray, target: float, most: int = MOST, sums: int = SUMS) -> tuple[int, np.ndarray]:
    """(whole passes, documents of each size to take once more) for a source with ``counts`` documents of each size.

    The words taken never exceed the target, and fall short of it by less than the smallest size of which a document is left (or by nothing).
    What the passes leave is first spread over all sizes in proportion; then the largest sizes take one more document each while the rest is beyond
    ``sums``; the rest is fitted exactly over the documents left.
    """
    extra = np.zeros(len(sizes), np.int64)
    total = int((sizes * counts).sum())
    if not total:
        return 0, extra
    passes = min(most, int(target // total))
    left = int(target) - passes * total
    if passes >= most or left <= 0:
        return passes, extra
    extra = np.array([int(n) * left // total for n in counts], np.int64)           # Python numbers: the product may pass 64 bits
    left -= int((extra * sizes).sum())
    order = np.argsort(-sizes, kind="stable")
    while left >= sums:
        before = left
        for i in order:
            if left < sums:
                break
            if 0 < sizes[i] <= left and extra[i] < counts[i]:
                more = min(int(counts[i] - extra[i]), max(1, (left - sums) // int(sizes[i]) // len(sizes)))
                extra[i] += more
                left -= more * int(sizes[i])
        if left == before:
            return passes, extra                                                   # nothing that is left fits
    open_ = order[(sizes[order] > 0) & (sizes[order] <= left) & (extra[order] < counts[order])]
    extra[open_] += np.array(fit_sum(sizes[open_].tolist(), (counts - extra)[open_].tolist(), left), np.int64)
    return passes, extra


def targets(sources: DataFrame, s: Scratch, weights: Sequence[int] = WEIGHTS, share: int = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row a source.

    ``share`` percent of all words go to the sources by weight; a target beyond ``most`` times its source's size stops there, and the rest is
    shared again by weight, until none is above. Sources are weighed in the order of their code points, null last, by distributed places; each round
    brings two sums to the driver. Without words all targets are 0.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_place") % len(weights) + 1).cast("int"))
    own = s.store(numbered(sources, s, F.col("source").asc_nulls_last()).select("source", "source_size", weight.alias("weight"), (F.col("source_size") * most).alias("cap")))
    budget = share * (own.agg(F.sum("source_size")).first()[0] or 0) / 100
    level, capped = 0.0, -1
    while True:
        full = (F.col("cap") <= level * F.col("weight")) if capped >= 0 else F.lit(False)
        row = own.agg(F.sum(F.when(full, F.col("cap"))).alias("held"), F.sum(F.when(~full, F.col("weight"))).alias("open"), F.count_if(full).alias("n")).first()
        if row["n"] == capped or not row["open"]:
            break
        level, capped = (budget - (row["held"] or 0)) / row["open"], row["n"]
    return own.select("source", "source_size", F.least(F.col("cap").cast("double"), level * F.col("weight")).alias("target"))


FITTED = "source string, size long, n long, source_size long, target double, passes int, extra long"


def _fit(most: int, sums: int):
    def of(group: pa.Table) -> pa.Table:
        sizes, counts = group["size"].to_numpy(), group["n"].to_numpy()
        order = np.argsort(sizes, kind="stable")                                   # the same choice in whatever order the rows arrive
        group = group.take(pa.array(order))
        passes, extra = fit_budget(sizes[order], counts[order], group["target"][0].as_py(), most, sums)
        return group.append_column("passes", pa.array(np.full(len(order), passes, np.int32))).append_column("extra", pa.array(extra)).select(
            ["source", "size", "n", "source_size", "target", "passes", "extra"])

    return of


def _repeats():
    """Rows as often as they were counted, the first ``more`` of them taken once more: in slices, however often."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            copies, more = batch.column("copies").to_numpy(), batch.column("more").to_numpy()
            kept = batch.drop_columns(["copies", "more"])
            many = np.flatnonzero(copies > 1)
            single = kept.take(pa.array(np.flatnonzero(copies == 1)))
            yield single.append_column("times", pa.array(single.column("passes").to_numpy() + more[copies == 1].astype(np.int32)))
            for i in many.tolist():
                for at in range(0, int(copies[i]), CHUNK_ROWS):
                    n = np.arange(at, min(at + CHUNK_ROWS, int(copies[i])))
                    rows = kept.take(pa.array(np.full(len(n), i)))
                    yield rows.append_column("times", pa.array(rows.column("passes").to_numpy() + (n < more[i]).astype(np.int32)))

    return run


def mix(docs: DataFrame, s: Scratch, weights: Sequence[int] = WEIGHTS, share: int = SHARE, most: int = MOST, seed: int = SEED,
        sums: int = SUMS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(doc_id, source, size, source_size, target, times) of each row of ``docs`` (doc_id, text, source): how often the mix takes it whole.

    A null or empty text has size 0 and is taken as its source's passes are, which adds nothing. A null source is a source of its own. All documents
    of a source are taken in as many passes as its target holds; which are taken once more follows from their lengths alone, and among those of one length from a
    seeded hash of the doc_id, so reruns agree. Rows with the same doc_id, source and size are equal here; the first of them are taken. A length's documents
    are ranked in chunks of about ``chunk_rows`` by hash, so that one length, or one source, may hold most rows. Per source one task sees one row for each length.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = s.store(docs.select("doc_id", "source", size.alias("size")).groupBy("doc_id", "source", "size").agg(F.count("*").alias("copies")))
    lengths = s.store(rows.groupBy("source", "size").agg(F.sum("copies").alias("n")))
    goal = targets(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), s, weights, share, most)
    goal = s.store(goal.withColumnRenamed("source", "_source"))
    plan = s.store(lengths.join(goal, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
                   .groupBy("source").applyInArrow(_fit(most, sums), FITTED))
    small = plan.count() <= BROADCAST_ROWS
    fitted = plan.select(F.col("source").alias("_source"), F.col("size").alias("_size"), "n", "source_size", "target", "passes", "extra")
    match = F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size"))
    rows = rows.join(F.broadcast(fitted) if small else fitted, match).drop("_source", "_size")
    # Lengths of which none or all are taken need no ranks.
    sure = rows.where("extra = 0 or extra = n").withColumn("more", F.when(F.col("extra") > 0, F.col("copies")).otherwise(F.lit(0)).cast("long"))
    drawn = rows.where("extra > 0 and extra < n").withColumn("draw", F.xxhash64("doc_id", F.lit(seed)))
    parts = F.col("n").cast("double") / chunk_rows
    chunk = F.floor((F.col("draw").cast("double") / 2.0 ** 64 + 0.5) * F.ceil(parts))
    drawn = s.store(drawn.withColumn("chunk", chunk.cast("long")))
    sums_ = drawn.groupBy("source", "size", "chunk").agg(F.sum("copies").alias("held"))
    up_to = W.partitionBy("source", "size").orderBy("chunk").rowsBetween(W.unboundedPreceding, 0)
    before = s.store(sums_.withColumn("before", F.sum("held").over(up_to) - F.col("held")).select(
        F.col("source").alias("_source"), F.col("size").alias("_size"), F.col("chunk").alias("_chunk"), "before", "held"))
    drawn = drawn.join(before, F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size")) & (F.col("chunk") == F.col("_chunk")))
    room = F.col("extra") - F.col("before")
    cut = (room > 0) & (room < F.col("held"))                                       # one chunk a length holds the last document taken
    inside = F.sum("copies").over(W.partitionBy("source", "size", "chunk").orderBy("draw", F.col("doc_id").asc_nulls_last()).rowsBetween(W.unboundedPreceding, 0))
    columns = ["doc_id", "source", "size", "copies", "source_size", "target", "passes"]
    ranked = drawn.where(cut).withColumn("more", F.greatest(F.lit(0), F.least("copies", room - inside + F.col("copies"))))
    clear = drawn.where(~cut).withColumn("more", F.when(room > 0, F.col("copies")).otherwise(F.lit(0)))
    out = [d.select(*columns, F.col("more").cast("long").alias("more")) for d in (sure, ranked, clear)]
    return out[0].unionByName(out[1]).unionByName(out[2]).mapInArrow(
        _repeats(), "doc_id long, source string, size long, source_size long, target double, passes int, times int").drop("passes")


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Scratch(spark, "mixing") as s:
        mixed = mix(table(spark, sf_dir, "documents"), s)
        return s.result(mixed.select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken")))
