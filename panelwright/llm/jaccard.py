"""Near-duplicate documents by exact Jaccard similarity of word shingles: a blocked sparse matrix product.

The incidence matrix has a row per distinct shingle set and a column per shingle. Two sets of sizes a <= b with
similarity of at least p/100 differ in at most (100 - p)(a + b)/(100 + p) shingles. The columns are therefore cut,
by hash, into more blocks than that: rows that link agree in at least one whole block. Only pairs that agree in a
block are multiplied; their overlap is accumulated column range by column range, and a pair is dropped as soon as what
is left cannot lift it to its bound. Columns that very many rows share are left out of the blocks where that loses nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.llm.common import Scratch, batches, table
from panelwright.llm.words import Words, mix, slices, spans

LEADERS = 1              # members of a block's group that all others are paired with at once
CELL_A, CELL_B = 256, 2048   # rows of the two sides of one block of the product over a crowded group
COLUMNS = 2048           # columns of it that are multiplied at a time
RANGES = 4               # column ranges of the accumulation
COUNTERS = 1 << 16       # of the sketch that finds columns shared by very many rows
EDGES_PER_TASK = 1 << 20   # of a round of the component search, about
HOT_SHARE = 0.001        # a column is very common from about this share of the documents on

MOST_BITS = 27           # of the bitmap that spares other documents' texts a shuffle: 16 MB
SHARES = 64              # hash ranges of the columns whose counts bound an overlap before the sets are multiplied
MOST_COUNT = 255         # of a range in the bound; more counts as no bound

SETS = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("s1", pa.int64()), ("s2", pa.int64()), ("counter", pa.int32()), ("shares", pa.binary())])
KEYS = pa.schema([("key", pa.int64()), ("s1", pa.int64())])
KEY_BYTES = 6            # of a key that are sent: keys that agree in them only make candidates, whose sets are compared
HELD_KEYS = 1 << 18      # keys of a task that are packed together
PACKED = pa.schema([("part", pa.int32()), ("n", pa.int32()), ("cells", pa.binary())])
GROUPS = pa.schema([("key", pa.int64()), ("a1", pa.int64()), ("b1", pa.int64()), ("place", pa.int32())])
EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def shingles(raw: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each text, sorted. Fewer words than ``size`` make one shingle."""
    w = Words(raw, offsets, lower=True)
    h = w.hashes()
    at = np.flatnonzero(w.in_row(size))
    few = np.flatnonzero((w.counts() > 0) & (w.counts() < size))
    row = np.concatenate([w.rows()[at], few])
    gram = np.concatenate([spans(h, at, at + size), spans(h, w.first[few], w.first[few + 1])])
    order = np.lexsort((gram, row))
    row, gram = row[order], gram[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
    return row[new], gram[new]


def _per_row(row: np.ndarray, rows: int) -> np.ndarray:
    return np.searchsorted(row, np.arange(rows + 1))


def _totals(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values[first[i]:first[i + 1]] modulo 2^64."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return sums[first[1:]] - sums[first[:-1]]


def _counter(gram: np.ndarray) -> np.ndarray:
    return (mix(gram, 15) >> np.uint64(48)).astype(np.int64)


def _shares(row: np.ndarray, gram: np.ndarray, rows: int) -> list[bytes]:
    """Per row how many of its columns lie in each of ``SHARES`` hash ranges, a byte each."""
    cell = row * SHARES + (mix(gram, 16) >> np.uint64(58)).astype(np.int64)
    count = np.minimum(np.bincount(cell, minlength=rows * SHARES), MOST_COUNT).astype(np.uint8).reshape(rows, SHARES)
    return [c.tobytes() for c in count]


def _within(percent: int):
    """Of each batch of pairs those whose overlap can still reach its bound: it is at most the sum of the smaller counts of each range."""

    def run(stream):
        for batch in stream:
            n = len(batch)
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(n, SHARES) for c in ("ca", "cb"))
            na, nb = batch.column("na").to_numpy().astype(np.int64), batch.column("nb").to_numpy().astype(np.int64)
            low = np.minimum(a, b)
            most = np.where((low == MOST_COUNT).any(axis=1), np.minimum(na, nb), low.sum(axis=1, dtype=np.int64))
            keep = pa.array((most >= -(-percent * (na + nb) // (100 + percent))))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    return run


def _sets(size: int):
    """Per document its set size, 128-bit digest and counts by hash range; at the end of a partition how many of its sets fall on each counter (n)."""

    def run(stream):
        total = np.zeros(COUNTERS, np.int64)
        for batch in stream:
            for a, e, raw, off in slices(batch.column("text")):
                row, gram = shingles(raw, off, size)
                first = _per_row(row, e - a)
                total += np.bincount(_counter(gram), minlength=COUNTERS)
                columns = [batch.column("doc_id").slice(a, e - a), np.diff(first).astype(np.int32),
                           _totals(mix(gram, 1), first).view(np.int64), _totals(mix(gram, 2), first).view(np.int64)]
                yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in columns], pa.nulls(e - a, pa.int32()),
                                                  pa.array(_shares(row, gram, e - a), pa.binary())], schema=SETS)
        used = np.flatnonzero(total)
        none = pa.nulls(len(used), pa.int64())
        yield pa.RecordBatch.from_arrays([none, pa.nulls(len(used), pa.int32()), pa.array(total[used]), none, pa.array(used, pa.int32()),
                                          pa.nulls(len(used), pa.binary())], schema=SETS)

    return run


def common_counters(sets: DataFrame) -> np.ndarray:
    """Counters that hold a column of very many rows: far above the mean of all. COUNTERS rows reach the driver."""
    count = np.zeros(COUNTERS, np.int64)
    found = sets.where("counter is not null").groupBy("counter").agg(F.sum("s1").alias("n")).toArrow()
    count[found["counter"].to_numpy()] = found["n"].to_numpy()
    rows = sets.where("counter is null").count()
    return count > count.mean() + 6 * np.sqrt(count.mean()) + max(32, HOT_SHARE * rows)


def most_differences(smaller, percent: int):
    """The most shingles in which a set of this size can differ from a linked one that is no smaller."""
    return smaller * (100 - percent) // percent


def needed(differences, percent: int):
    """Blocks for so many differences: more of them where blocks are small and some stay empty."""
    return differences + 2 + (differences // 10 if percent < 88 else 0)


def block_counts(largest: int, percent: int) -> np.ndarray:
    """Numbers of column blocks in use, growing by about half; 1 stands for sets that only link with equal ones."""
    grid = [1, 3]
    while grid[-1] < needed(most_differences(largest, percent), percent):
        grid.append(max(grid[-1] + 1, int(grid[-1] * 1.5)))
    return np.array(grid)


def _keys(size: int, percent: int, common):
    """One key per column block of each set that holds anything but common columns.

    With m blocks and at most d differences, a linked pair agrees in m - d blocks or more. If a set has fewer than that many blocks
    without a rare column, one of the agreed blocks has a rare column in both sets, and its key suffices. Sets with more get keys of all
    columns too, and if even those leave too many blocks empty, keys of the empty blocks: two linked sets that both need them both have them.
    """

    def of(batch: pa.RecordBatch):
        hot = common.value
        for _, _, raw, off in slices(batch.column("text")):
            row, gram = shingles(raw, off, size)
            first = _per_row(row, len(off) - 1)
            n = np.diff(first)
            if not len(gram):
                continue
            s1 = _totals(mix(gram, 1), first).view(np.int64)
            keep = np.zeros(len(n), bool)
            keep[np.unique(s1, return_index=True)[1]] = True                      # copies within the slice
            grid = block_counts(int(n.max()), percent)
            differences = np.arange(int(n.max()) + 1)
            reach = np.array([int(np.searchsorted(needed(differences, percent), g, "right")) - 1 for g in grid])   # most differences g serves
            most = most_differences(n, percent)
            least = most_differences(-(-n * percent // 100), percent)              # of the smallest possible partner
            level = np.searchsorted(grid, np.where(most > 0, needed(most, percent), 1))
            lower = np.searchsorted(grid, np.where(least > 0, needed(least, percent), 1))
            value, place, rare = mix(gram, 12), mix(gram, 11) >> np.uint64(32), ~hot[_counter(gram)]
            for step in range(int((level - lower).max()) + 1):
                use = level - step
                rows = keep & (use >= lower) & (grid[np.maximum(use, 0)] > 1)
                for every in (False, True):                                        # rare columns only, then all of them
                    if not rows.any():
                        break
                    blocks = np.where(rows, grid[np.maximum(use, 0)], 0)
                    base = np.append(0, np.cumsum(blocks))
                    on = rows[row] & (rare | every)
                    block = (place[on] * blocks[row[on]].astype(np.uint64)) >> np.uint64(32)
                    cell = base[row[on]] + block.astype(np.int64)
                    sums, filled = np.zeros(base[-1], np.uint64), np.zeros(base[-1], bool)
                    np.add.at(sums, cell, value[on])
                    filled[cell] = True
                    owner = np.repeat(np.arange(len(n)), blocks)
                    name = (blocks[owner].astype(np.uint64) << np.uint64(32)) + (np.arange(base[-1]) - base[owner]).astype(np.uint64)
                    empty = np.bincount(owner[~filled], minlength=len(n))
                    short = rows & (empty >= blocks - reach[np.maximum(use, 0)])
                    out = filled | short[owner] if every else filled
                    owner, name, sums = owner[out], name[out], sums[out]
                    yield {"key": mix(mix(name, 13 + every) + sums, 14).view(np.int64), "s1": s1[owner]}
                    rows = short

    return batches(of, KEYS)


def _parts(spark: SparkSession) -> np.ndarray:
    """For each shuffle partition a number that Spark deals to it; very few of them may be left out."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    number = F.col("id").cast("int")
    found = spark.range(12 * n).groupBy(F.pmod(F.hash(number), F.lit(n)).alias("slot")).agg(F.min(number).alias("part")).collect()   # one a partition
    return np.array(sorted(r["part"] for r in found), np.int32)


def _packed_keys(make, parts: np.ndarray):
    """The rows of ``make`` (key, s1) by partition: of each key ``KEY_BYTES``, then of each its s1, as they come. A row for each key would take about half as much again."""

    def sent(held: list):
        key, s1 = (np.concatenate([h[i] for h in held]) for i in (0, 1))
        key = key.view(np.uint64) >> np.uint64(64 - 8 * KEY_BYTES)
        slot = (key % np.uint64(len(parts))).astype(np.int32)
        order = np.argsort(slot, kind="stable")
        short, s1 = key[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES], s1[order]
        n = np.bincount(slot, minlength=len(parts))
        ends = np.cumsum(n)
        used = np.flatnonzero(n)
        cells = [short[ends[u] - n[u]:ends[u]].tobytes() + s1[ends[u] - n[u]:ends[u]].tobytes() for u in used]
        return pa.RecordBatch.from_arrays([pa.array(parts[used]), pa.array(n[used].astype(np.int32)), pa.array(cells, pa.binary())], schema=PACKED)

    def run(stream):
        held, n = [], 0
        for batch in make(stream):
            held.append((batch.column("key").to_numpy(), batch.column("s1").to_numpy()))
            n += len(batch)
            if n >= HELD_KEYS:
                yield sent(held)
                held, n = [], 0
        if n:
            yield sent(held)

    return run


def _opened_keys(stream):
    """The keys (key, s1) of packed rows."""
    for batch in stream:
        for n, cells in zip(batch.column("n").to_pylist(), batch.column("cells"), strict=True):
            raw = np.frombuffer(cells.as_buffer(), np.uint8)
            key = np.zeros((n, 8), np.uint8)
            key[:, :KEY_BYTES] = raw[:n * KEY_BYTES].reshape(n, KEY_BYTES)
            yield pa.RecordBatch.from_arrays([pa.array(key.view("<i8").ravel()), pa.array(np.frombuffer(raw[n * KEY_BYTES:].tobytes(), np.int64))], schema=KEYS)


def _groups():
    """Pairs within key groups from rows sorted by (key, s1), and the members of groups beyond ``LEADERS`` + 1.

    A pair joins a member with one of the group's first ``LEADERS``. A member row has side a only, with its place in the group. Only the
    first members of the group in hand are held, whatever its size.
    """

    def run(stream):
        key0, s0 = np.zeros(0, np.int64), np.zeros(0, np.int64)            # first members of the open group
        told, last = 0, None                                               # its members so far, the last row seen
        for batch in stream:
            key, s1 = batch.column("key").to_numpy(), batch.column("s1").to_numpy()
            if not len(key):
                continue
            fresh = np.ones(len(key), bool)
            fresh[1:] = (key[1:] != key[:-1]) | (s1[1:] != s1[:-1])
            fresh[0] = (key[0], s1[0]) != last
            last = (key[-1], s1[-1])
            key, s1 = key[fresh], s1[fresh]
            if not len(key):
                continue
            old = len(key0) if len(key0) and key0[0] == key[0] else 0
            key, s1 = np.concatenate([key0[:old], key]), np.concatenate([s0[:old], s1])
            begin = np.ones(len(key), bool)
            begin[1:] = key[1:] != key[:-1]
            starts = np.flatnonzero(begin)
            width = np.diff(np.append(starts, len(key)))
            start, is_new = np.repeat(starts, width), np.arange(len(key)) >= old
            hidden = (told - old) if old else 0                            # members of the open group that are not held
            place = np.arange(len(key)) - start + np.where((start == 0) & is_new, hidden, 0)
            pairs = [(start[at] + d, at) for d in range(LEADERS) for at in [np.flatnonzero(is_new & (place > d))]]
            size = width + np.where(starts == 0, hidden, 0)
            big = np.repeat(size > LEADERS + 1, width)
            known = (start == 0) & bool(old) & (told > LEADERS + 1)
            member = np.flatnonzero(big & (is_new | ~known))
            a, b = np.concatenate([x[0] for x in pairs]), np.concatenate([x[1] for x in pairs])
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(key[a]), pa.array(s1[a]), pa.array(s1[b]), pa.nulls(len(a), pa.int32())], schema=GROUPS)
            if len(member):
                yield pa.RecordBatch.from_arrays([pa.array(key[member]), pa.array(s1[member]), pa.nulls(len(member), pa.int64()),
                                                  pa.array(place[member].astype(np.int32))], schema=GROUPS)
            told = int(place[-1]) + 1
            key0, s0 = key[starts[-1]:starts[-1] + LEADERS + 1], s1[starts[-1]:starts[-1] + LEADERS + 1]

    return run


def _slot(doc: str, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(doc, F.lit(23)), 64 - bits)


def flags_of(nodes: DataFrame, count: int) -> tuple[int, np.ndarray]:
    """(bits, words): a bitmap in which the slots of all nodes are set, 16 or more slots a node up to 2^``MOST_BITS`` of them.

    It only spares rows a shuffle that are surely no nodes; where it is too small for its nodes it spares fewer. Its words are all that reaches the driver.
    """
    bits = min(MOST_BITS, max(10, (16 * count).bit_length()))
    slot = nodes.select(_slot("node", bits).alias("slot"))
    words = slot.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(max(1, (1 << bits) >> 6), np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return bits, out


def _maybe(flags):
    """Rows whose slot is set."""
    def run(stream):
        words = flags.value.view(np.uint64)
        for batch in stream:
            slot = batch.column("slot").to_numpy()
            keep = (words[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1)
            yield batch.filter(pa.array(keep == 1)).select(["doc_id", "text"])

    return run


def _flagged(flags):
    """Whether a row's slot is set, as a column."""
    @F.arrow_udf(T.BooleanType())
    def of(slot: pa.Array) -> pa.Array:
        slot, words = slot.to_numpy(), flags.value.view(np.uint64)
        return pa.array(((words[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1)) == 1)

    return of


def _grams(size: int):
    def of(batch: pa.RecordBatch):
        for a, e, raw, off in slices(batch.column("text")):
            row, gram = shingles(raw, off, size)
            first = _per_row(row, e - a)
            yield {"node": batch.column("doc_id").slice(a, e - a),
                   "grams": [gram[first[i]:first[i + 1]].tobytes() for i in range(e - a)]}

    return batches(of, pa.schema([("node", pa.int64()), ("grams", pa.binary())]))


def _linked(percent: int, block: int = 64):
    """The pairs of each batch that reach the similarity; ``block`` rows of the product at a time."""

    def of(batch: pa.RecordBatch):
        for at in range(0, len(batch), block):
            part = batch.slice(at, block)
            left = [np.frombuffer(x, np.uint64) for x in part.column("ga").to_pylist()]
            right = [np.frombuffer(x, np.uint64) for x in part.column("gb").to_pylist()]
            na, nb = np.array([len(x) for x in left]), np.array([len(x) for x in right])
            bound = -(-percent * (na + nb) // (100 + percent))               # least overlap of a linked pair
            seen, done_a, done_b = np.zeros(len(na), int), np.zeros(len(na), int), np.zeros(len(na), int)
            alive = np.minimum(na, nb) >= bound
            for r in range(RANGES):
                edge = np.uint64((2 ** 64 // RANGES) * (r + 1) - 1)
                for i in np.flatnonzero(alive):
                    to_a = np.searchsorted(left[i], edge, "right") if r < RANGES - 1 else na[i]
                    to_b = np.searchsorted(right[i], edge, "right") if r < RANGES - 1 else nb[i]
                    x, y = left[i][done_a[i]:to_a], right[i][done_b[i]:to_b]
                    if len(x) and len(y):
                        spot = np.searchsorted(y, x)
                        seen[i] += int((y[np.minimum(spot, len(y) - 1)] == x).sum())
                    done_a[i], done_b[i] = to_a, to_b
                alive &= seen + np.minimum(na - done_a, nb - done_b) >= bound
            yield {"a": part.column("a").filter(pa.array(alive)), "b": part.column("b").filter(pa.array(alive))}

    return batches(of, pa.schema([("a", pa.int64()), ("b", pa.int64())]))


def _cell(percent: int):
    """Links of one block of a crowded group: side a, outside its main component, times side b; one link per row and component."""

    def of(one: pa.Table, other: pa.Table) -> pa.Table:
        a, b = (t["node"].to_numpy() for t in (one, other))
        out = np.zeros((0, 2), np.int64)
        if len(a) and len(b):
            ga, gb = ([np.frombuffer(x, np.uint64) for x in t["grams"].to_pylist()] for t in (one, other))
            na, nb = np.array([len(x) for x in ga]), np.array([len(x) for x in gb])
            bound = -(-percent * (na[:, None] + nb) // (100 + percent))
            flat_a, flat_b = np.concatenate(ga), np.concatenate(gb)
            shared = np.intersect1d(flat_a, flat_b)
            row_a, row_b = np.repeat(np.arange(len(a)), na), np.repeat(np.arange(len(b)), nb)
            ca, cb = np.searchsorted(shared, flat_a), np.searchsorted(shared, flat_b)
            in_a = np.isin(flat_a, shared, assume_unique=False)
            in_b = np.isin(flat_b, shared, assume_unique=False)
            row_a, ca, row_b, cb = row_a[in_a], ca[in_a], row_b[in_b], cb[in_b]
            seen = np.zeros((len(a), len(b)), np.int64)
            left = np.minimum(np.bincount(row_a, minlength=len(a))[:, None], np.bincount(row_b, minlength=len(b)))
            for at in range(0, len(shared), COLUMNS):
                if not (seen + left >= bound).any():
                    break
                x, y = np.zeros((len(a), COLUMNS), np.float32), np.zeros((len(b), COLUMNS), np.float32)
                ka, kb = (ca >= at) & (ca < at + COLUMNS), (cb >= at) & (cb < at + COLUMNS)
                x[row_a[ka], ca[ka] - at] = 1
                y[row_b[kb], cb[kb] - at] = 1
                seen += (x @ y.T).astype(np.int64)
                left -= np.minimum(x.sum(1)[:, None], y.sum(1)).astype(np.int64)
                left = np.maximum(left, 0) if at + COLUMNS < len(shared) else left * 0
            # ``left`` may only shrink too slowly: min of sums is at least the sum of mins, so no pair leaves early that could link.
            i, j = np.nonzero((seen >= bound) & (a[:, None] != b))
            label = other["component"].to_numpy()[j]
            keep = np.unique(np.stack([i, label]), axis=1, return_index=True)[1] if len(i) else np.zeros(0, int)
            out = np.stack([a[i[keep]], b[j[keep]]], axis=1)
        return pa.table({"a": pa.array(out[:, 0], pa.int64()), "b": pa.array(out[:, 1], pa.int64())})

    return of


def components(edges: DataFrame, s: Scratch) -> DataFrame:
    """(node, component): the smallest node reachable over ``edges`` (a, b), for the nodes that have edges.

    Each round every node links its neighbours to the smallest node it sees (first the larger neighbours, then all), until
    the edges are stars: no node points at two others, and none that is pointed at points further. As edges point at
    smaller nodes, a star's centre is its component's smallest. The edges stay in tables; one row reaches the driver.
    """
    def unsettled(e: DataFrame) -> tuple[int, int]:
        """Nodes at which the edges are no stars yet; all edges."""
        ends = e.select(F.explode(F.array("a", "b")).alias("node"), F.col("a"))
        turns = ends.groupBy("node").agg(F.count_if(F.col("node") == F.col("a")).alias("up"), F.count("*").alias("n"))
        bad, n = turns.agg(F.count_if(F.expr("up > 1 or (up = 1 and n > 1)")), F.sum("up")).first()
        return bad, n or 0

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else e
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        hop = both.join(low, "a")
        if large:
            return hop.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a > b").distinct()
        return (hop.select(F.col("b").alias("a"), F.col("low").alias("b"))
                .unionByName(low.select("a", F.col("low").alias("b"))).where("a > b").distinct())

    e = s.store(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct())
    cores = e.sparkSession.sparkContext.defaultParallelism
    while True:
        bad, n = unsettled(e)
        if not bad:
            break
        # A round at most doubles the edges. They are written in parts of some size, however many shuffle partitions there are.
        before = s.tables
        e = s.store(star(star(e, True), False).coalesce(max(cores, 2 * n // EDGES_PER_TASK)))
        s.drop(before)
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _roots(a: np.ndarray, b: np.ndarray, rows: int) -> np.ndarray:
    """The smallest row reachable from each of ``rows`` rows over the edges (a, b)."""
    root = np.arange(rows)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        for at in (a, b, root[a], root[b]):
            np.minimum.at(new, at, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _near_rows(node: np.ndarray, component: np.ndarray, n: np.ndarray, left: np.ndarray, right: np.ndarray, shares: np.ndarray,
               percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Of one cell the edges (a, b) that join what its pairs of a left and a right row join: those of two components whose counts allow a link."""
    l, r = np.flatnonzero(left), np.flatnonzero(right)
    full = (shares == MOST_COUNT).any(axis=1)
    found = []
    step = max(1, (1 << 20) // (SHARES * max(1, len(r))))
    for at in range(0, len(l), step):
        i = l[at:at + step]
        small, both = np.minimum(n[i][:, None], n[r]), n[i][:, None] + n[r]
        most = np.minimum(shares[i][:, None], shares[r]).sum(axis=2, dtype=np.int64)
        most = np.where(full[i][:, None] & full[r], small, np.minimum(most, small))
        x, y = np.nonzero((most >= -(-percent * both // (100 + percent))) & (component[i][:, None] != component[r]))
        found.append((i[x], r[y]))
    a, b = (np.concatenate([f[side] for f in found]) for side in (0, 1))
    if not len(a):
        return a, b
    root = _roots(a, b, len(node))
    at = np.flatnonzero(root != np.arange(len(node)))
    return node[at], node[root[at]]


def _near(percent: int):
    """Edges of each cell from rows sorted by (key, i, j); the rows of the cell in hand are held, at most about ``CELL_A`` + ``CELL_B``."""

    def told(rows: pa.Table):
        node, component, n = (rows[c].to_numpy().astype(np.int64) for c in ("node", "component", "n"))
        left, right = (rows[c].to_numpy().astype(bool) for c in ("l", "r"))
        shares = np.frombuffer(b"".join(rows["shares"].to_pylist()), np.uint8).reshape(len(node), SHARES)
        cell = np.stack([rows[c].to_numpy().astype(np.int64) for c in ("key", "i", "j")])
        starts = np.append(np.flatnonzero(np.append(True, (cell[:, 1:] != cell[:, :-1]).any(axis=0))), len(node))
        some = np.append(0, np.cumsum(left))
        edges = [_near_rows(*[c[x:y] for c in (node, component, n, left, right, shares)], percent)
                 for x, y in zip(starts[:-1], starts[1:]) if y - x > 1 and some[y] > some[x]]
        if edges:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([e[side] for e in edges]), pa.int64()) for side in (0, 1)], schema=EDGES)

    def run(stream):
        held = None
        for batch in stream:
            if not len(batch):
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            last = len(rows)
            same = np.ones(last, bool)
            for c in ("key", "i", "j"):
                same &= rows[c].to_numpy() == rows[c][-1].as_py()
            cut = int(np.argmax(same))                                     # the open cell's first row
            if cut:
                yield from told(rows.slice(0, cut))
            held = rows.slice(cut)
        if held is not None:
            yield from told(held)

    return run


def _dealt_groups(members: DataFrame) -> DataFrame:
    """``members`` (key, node, component) of the keys with rows outside their largest component (main), which meet all: in m and k parts."""
    parts = (members.groupBy("key", "component").agg(F.count("*").alias("c")).groupBy("key")
             .agg(F.max_by("component", F.struct("c", "component")).alias("main"), F.max("c").alias("most"), F.sum("c").alias("c"))
             .withColumn("x", F.col("c") - F.col("most")).where("x > 0")
             .select("key", "main", F.ceil(F.col("x") / CELL_A).cast("int").alias("m"), F.ceil(F.col("c") / CELL_B).cast("int").alias("k")))
    return members.join(parts, "key")


def _candidates(members: DataFrame, classes: DataFrame, percent: int, s: Scratch) -> DataFrame:
    """Edges (a, b) that connect every two members of a group that may link: in different components, and their counts by hash range allow it.

    A cell of a group holds 64 bytes a member in place of its set, and tells no more edges than it has rows.
    """
    crowd = s.store(_dealt_groups(members)).join(classes.select("node", "n", "shares"), "node")
    part = {c: f"cast(pmod(xxhash64(node), {c}) as int)" for c in ("m", "k")}
    cells = F.expr(f"""if(m = 1 and k = 1, array(struct(0 as i, 0 as j, component <> main as l, true as r)), concat(
        transform(sequence(0, m - 1), x -> struct(x as i, {part['k']} as j, false as l, true as r)),
        if(component <> main, transform(sequence(0, k - 1), x -> struct({part['m']} as i, x as j, true as l, false as r)), array())))""")
    sent = crowd.select("key", "node", "component", "n", "shares", F.explode(cells).alias("cell")).select(
        "key", "cell.*", "node", "component", "n", "shares")
    return sent.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_near(percent), "a long, b long")


def _crowded(members: DataFrame, classes: DataFrame, grams_of, percent: int, s: Scratch) -> DataFrame:
    """Further links (a, b) within crowded groups: who is outside a group's main component still has to meet the others.

    ``members`` has (key, node, component) without the members that led a group, which have met everyone in it. Members that may link, by the
    bound of their counts, make clusters, each within one component of these candidates: only their sets are sent, once for all groups they share.
    ``grams_of`` gives (node, grams) of a table of nodes.
    """
    near = s.store(_candidates(members, classes, percent, s))
    cluster = components(near, s).select("node", F.col("component").alias("key"))
    crowd = s.store(_dealt_groups(members.select("node", "component").distinct().join(cluster, "node")))
    grams = grams_of(s.store(crowd.select("node").distinct()))

    def dealt(df: DataFrame, by: str, across: str) -> DataFrame:
        part = F.pmod(F.xxhash64("node"), F.col(by)).cast("int")
        out = df.withColumn("o", F.explode(F.sequence(F.lit(0), F.col(across) - 1)))
        i, j = (part, F.col("o")) if by == "m" else (F.col("o"), part)
        # Neither side is small for being so on disk: both repeat sets, or ids, by the cells.
        out = out.select("key", i.alias("i"), j.alias("j"), "node", "component").hint("merge").join(grams, "node")
        return out.select(*[F.col(c).alias(c) for c in out.columns]).groupBy("key", "i", "j")   # columns of their own for either side

    return dealt(crowd.where("component <> main"), "m", "k").cogroup(dealt(crowd, "k", "m")).applyInArrow(
        _cell(percent), "a long, b long")


def similar_groups(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of ``docs`` (doc_id, text, any other columns).

    Documents link when the Jaccard similarity of their sets of lower-cased ``size``-word shingles is at least
    ``percent``/100; component_id is the smallest doc_id reachable. Null and empty texts have no shingles and link with nothing.
    Equal sets are one row of the matrix (never pairs). A row with a null doc_id links with nothing and has a null component.
    """
    spark, rows = docs.sparkSession, docs.select("doc_id", "text")
    with Scratch(spark, "jaccard") as s:
        told = s.store(rows.mapInArrow(_sets(size), "doc_id long, n int, s1 long, s2 long, counter int, shares binary"))
        sets = told.where("counter is null").drop("counter", "shares")
        common = spark.sparkContext.broadcast(common_counters(told))       # COUNTERS flags
        classes = s.store(told.where("counter is null and n > 0 and doc_id is not null").groupBy("s1", "s2").agg(
            F.min("doc_id").alias("node"), F.min("n").alias("n"), F.min("shares").alias("shares")))
        keys = rows.where("doc_id is not null").mapInArrow(_packed_keys(_keys(size, percent, common), _parts(spark)), "part int, n int, cells binary")
        opened = keys.repartition("part").mapInArrow(_opened_keys, "key long, s1 long")
        found = s.store(opened.sortWithinPartitions("key", "s1").mapInArrow(
            _groups(), "key long, a1 long, b1 long, place int"))
        found_at = s.tables

        def side(c: str) -> DataFrame:
            return classes.select(F.col("s1").alias(f"{c}1"), F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("shares").alias(f"c{c}"))

        fits = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
        pairs = s.store(found.where("place is null").select("a1", "b1").distinct().join(side("a"), "a1").join(side("b"), "b1")
                        .where(fits).select("a", "b", "na", "nb", "ca", "cb").mapInArrow(_within(percent), "a long, b long"))
        members = s.store(found.where("place is not null").join(side("a"), "a1").select(
            "key", F.col("a").alias("node"), (F.col("place") < LEADERS).alias("used")))
        s.drop(found_at)

        def grams_of(nodes: DataFrame) -> DataFrame:
            """The sets of a stored table of nodes, stored. Each time the texts are read again, and only those of these nodes are shuffled."""
            bits, words = flags_of(nodes, nodes.count())
            flags = spark.sparkContext.broadcast(words)                    # at most 2^MOST_BITS bits
            likely = rows.where("doc_id is not null").withColumn("slot", _slot("doc_id", bits)).mapInArrow(_maybe(flags), "doc_id long, text string")
            return s.store(likely.join(nodes, likely["doc_id"] == nodes["node"], "left_semi").mapInArrow(_grams(size), "node long, grams binary"))

        nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
        grams = grams_of(s.store(nodes.distinct()))
        grams_at = s.tables

        def own(side: str) -> DataFrame:
            return grams.select(F.col("node").alias(side), F.col("grams").alias(f"g{side}"))

        links = s.store(pairs.join(own("a"), "a").join(own("b"), "b").select("a", "b", "ga", "gb").mapInArrow(
            _linked(percent), "a long, b long"))
        s.drop(grams_at)
        found_in = s.store(components(links, s))
        members = members.join(found_in, "node", "left").withColumn("component", F.coalesce("component", "node"))
        members = members.where("not used").drop("used")                   # a leader has met everyone in its group
        unsettled = members.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
        members = s.store(members.join(unsettled.select("key"), "key"))
        if not members.isEmpty():
            late = s.store(_crowded(members, classes, grams_of, percent, s))
            # The components found so far stand for all links they came from.
            known = found_in.select(F.col("node").alias("a"), F.col("component").alias("b"))
            found_in = s.store(components(known.unionByName(late), s)) if not late.isEmpty() else found_in
        whole = sets.join(classes.drop("n", "shares"), ["s1", "s2"], "left").join(found_in, "node", "left")
        return s.result(whole.select(
            "doc_id", F.col("n").cast("long").alias("n_shingles"),
            F.when(F.col("n") > 0, F.coalesce("component", "node")).otherwise(F.col("doc_id")).alias("component_id")))


def one_of_each(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """The rows of ``docs`` that are the first of their group (all columns); rows with a null doc_id stay.

    Rows that share a doc_id are one document, and go if any of their texts is linked to a smaller id.
    """
    spark = docs.sparkSession
    with Scratch(spark, "jaccard-gone") as s:
        gone = s.result(similar_groups(docs, size, percent).where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct())
        bits, words = flags_of(gone.select(F.col("_gone").alias("node")), gone.count())
        marked = docs.withColumn("_likely", _flagged(spark.sparkContext.broadcast(words))(_slot("doc_id", bits)))
        # Rows that surely stay are not shuffled, however many ids are gone.
        likely, rest = marked.where("_likely").drop("_likely"), marked.where("not _likely").drop("_likely")
        return rest.unionByName(likely.join(gone, likely["doc_id"] == gone["_gone"], "left_anti"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(table(spark, sf_dir, "documents"))
