"""Removal of word windows that also occur in an earlier document (level-wise doubling)."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm.common import Scratch, batches, table, whole_rows
from panelwright.llm.words import Words, lowest, slices, spans, windows

RUNS = pa.schema([("anchor", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("doc_id", pa.int64()),
                  ("at", pa.int32()), ("n", pa.int32())])
WINDOWS = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int32())])
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _runs(start: int, window: int):
    """Per batch: the windows of each document, in runs that share their anchor.

    A window's anchor is the leftmost of its ``start``-word windows with the smallest hash, so equal
    windows have equal anchors. A run's context, all words from its first to its last window, is hashed to
    128 bits; equal contexts hold the same windows.
    """

    def of(batch: pa.RecordBatch):
        ids = batch.column("doc_id")
        for a, e, raw, off in slices(batch.column("text")):
            w = Words(raw, off)
            if len(w) < window:
                continue
            h = w.hashes()
            small = windows(h, start)
            pick = lowest(small, window - start + 1)
            at = np.flatnonzero(w.in_row(window)[:len(pick)])
            if not len(at):
                continue
            anchor, row = pick[at], w.rows()[at]
            cut = np.append(0, np.flatnonzero((np.diff(anchor) != 0) | (np.diff(row) != 0)) + 1)
            end = np.append(cut[1:], len(at))
            lo, hi = at[cut], at[end - 1] + window
            yield {"anchor": small[anchor[cut]].view(np.int64), "c1": spans(h, lo, hi, 1).view(np.int64),
                   "c2": spans(w.hashes(5), lo, hi, 2).view(np.int64),
                   "doc_id": ids.slice(a, e - a).take(pa.array(row[cut])),
                   "at": (lo - w.first[row[cut]]).astype(np.int32), "n": (end - cut).astype(np.int32)}

    return batches(of, RUNS)


def _marks(column: pa.Array, i: int, names: tuple[str, ...]) -> list[np.ndarray]:
    """The fields of row i of a column of struct arrays."""
    value = column[i]
    if not value.is_valid:
        return [np.zeros(0, np.int64) for _ in names]
    return [value.values.field(n).to_numpy(zero_copy_only=False) for n in names]


def _valid(h: np.ndarray, at: np.ndarray, n: np.ndarray, c1: np.ndarray, window: int) -> np.ndarray:
    """Which runs lie in this text with the recorded words (rows that share an id may hold different texts)."""
    fits = (at + n + window - 1 <= len(h))
    lo, hi = np.where(fits, at, 0), np.where(fits, at + n + window - 1, 0)
    return fits & (spans(h, lo, hi, 1).view(np.int64) == c1)


def _expand(window: int):
    """The single windows of the listed runs, each with a 128-bit hash of its words."""

    def of(batch: pa.RecordBatch):
        for a, e, raw, off in slices(batch.column("text")):
            w = Words(raw, off)
            h, h2 = w.hashes(), w.hashes(5)
            for i in range(a, e):
                own = slice(w.first[i - a], w.first[i - a + 1])
                at, n, c1 = _marks(batch.column("open"), i, ("at", "n", "c1"))
                ok = _valid(h[own], at, n, c1, window)
                if not ok.any():
                    continue
                at, n = at[ok], n[ok]
                p = np.unique(np.repeat(at - np.cumsum(n) + n, n) + np.arange(n.sum()))
                yield {"w1": spans(h[own], p, p + window, 1).view(np.int64),
                       "w2": spans(h2[own], p, p + window, 2).view(np.int64),
                       "doc_id": np.full(len(p), batch.column("doc_id")[i].as_py()), "at": p.astype(np.int32)}

    return batches(of, WINDOWS)


def _kept(batch: pa.RecordBatch, window: int):
    """Per slice: first and end row, word counts, removed counts, kept words of each row joined by one space."""
    for a, e, raw, off in slices(batch.column("text")):
        w = Words(raw, off)
        keep = np.ones(len(w), bool)
        h = None
        for i in range(a, e):
            at, n, c1 = _marks(batch.column("_runs"), i, ("at", "n", "c1"))
            if len(at):
                h = w.hashes() if h is None else h
                own = slice(w.first[i - a], w.first[i - a + 1])
                ok = _valid(h[own], at, n, c1, window)
                edge = np.zeros(own.stop - own.start + 1, np.int64)
                np.add.at(edge, at[ok], 1)
                np.add.at(edge, at[ok] + n[ok] + window - 1, -1)
                keep[own] = np.cumsum(edge[:-1]) == 0
        chosen = np.flatnonzero(keep)
        size = (w.ends - w.starts + 1)[chosen]                 # with the space after each word
        to = np.append(0, np.cumsum(size))
        text = np.append(w.data, np.uint8(32))[np.repeat(w.starts[chosen] - to[:-1], size) + np.arange(to[-1])]
        text[to[1:] - 1] = 32
        left = np.searchsorted(chosen, w.first)
        bound = to[left]
        texts = [text[bound[k]:max(bound[k], bound[k + 1] - 1)].tobytes() for k in range(e - a)]
        yield a, e, w.counts(), w.counts() - np.diff(left), texts


def _digests(window: int):
    def of(batch: pa.RecordBatch):
        for a, e, words, removed, texts in _kept(batch, window):
            yield {"doc_id": batch.column("doc_id").slice(a, e - a), "n_words": words, "n_removed": removed,
                   "kept_sha256": [hashlib.sha256(t).hexdigest() for t in texts]}

    return batches(of, pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                                  ("kept_sha256", pa.string())]))


def _rewrite(window: int):
    """Whole rows, held as one struct each, with the repeats taken out of their text."""

    def run(stream):
        for batch in stream:
            rows = pa.RecordBatch.from_struct_array(batch.column("_row"))
            names = rows.schema.names
            marked = pa.RecordBatch.from_arrays([rows.column("text"), batch.column("_runs")], ["text", "_runs"])
            for a, e, _, removed, texts in _kept(marked, window):
                part = rows.slice(a, e - a)
                old = part.column("text")
                new = pa.array([texts[k].decode() if removed[k] else old[k].as_py() for k in range(e - a)], pa.string())
                yield pa.RecordBatch.from_arrays([new if c == "text" else part.column(c) for c in names], names)

    return run


def mark_repeats(docs: DataFrame, s: Scratch, window: int = 50, start: int = 25) -> DataFrame:
    """The runs of windows to remove: (doc_id, at, n, c1), ``n`` windows from word ``at`` on.

    Level one shuffles one anchor of ``start`` words per run of windows. Anchors seen in one document only
    are dropped with all their windows. Where an anchor repeats, its neighbourhood is extended to the
    full windows: a run whose whole context also occurs in an earlier document is settled at once; the first
    document of a context is compared window by window only where the anchor has several contexts.
    """
    runs = docs.select("doc_id", "text").where("doc_id is not null").mapInArrow(
        _runs(start, window), "anchor long, c1 long, c2 long, doc_id long, at int, n int")
    alive = (runs.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
             .where("lo < hi").select("anchor"))
    # The grouped side is stored before it is joined: a join of two plain exchanges lets Spark split the rows of a hot key.
    alive = s.store(runs.join(s.store(alive), "anchor"))
    first = s.store(alive.groupBy("c1", "c2").agg(F.min("doc_id").alias("first")))
    alive = s.store(alive.join(first, ["c1", "c2"]))
    settled = alive.where("doc_id > first").select("doc_id", "at", "n", "c1")
    source = alive.where("doc_id = first")
    several = (source.groupBy("anchor").agg(F.min("c1").alias("a1"), F.max("c1").alias("b1"),
                                            F.min("c2").alias("a2"), F.max("c2").alias("b2"))
               .where("a1 < b1 or a2 < b2").select("anchor"))
    still = (source.join(several, "anchor").groupBy("doc_id")
             .agg(F.collect_list(F.struct("at", "n", "c1")).alias("open")))
    return s.store(settled), s.store(still)


def _second_level(docs: DataFrame, still: DataFrame, s: Scratch, window: int) -> DataFrame:
    """Windows of the open runs whose words also start in an earlier document."""
    single = s.store(docs.select("doc_id", "text").join(still, "doc_id").mapInArrow(
        _expand(window), "w1 long, w2 long, doc_id long, at int"))
    first = s.store(single.groupBy("w1", "w2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last"))
    return single.join(first.drop("last"), ["w1", "w2"]).where("doc_id > first").select(
        "doc_id", "at", F.lit(1).alias("n"), F.col("w1").alias("c1"))


def removals(docs: DataFrame, s: Scratch, window: int = 50, start: int = 25) -> DataFrame:
    """(doc_id, runs): per document the runs of windows to remove, no row where there are none."""
    settled, still = mark_repeats(docs, s, window, start)
    late = s.store(_second_level(docs, still, s, window))
    return s.store(settled.unionByName(late).groupBy("doc_id").agg(F.collect_list(F.struct("at", "n", "c1")).alias("_runs")))


def remove_repeats(docs: DataFrame, window: int = 50, start: int = 25) -> DataFrame:
    """``docs`` with repeated passages taken out of ``text``; all other columns and all rows stay.

    A word goes if it lies in a window of ``window`` consecutive words that also starts in a document with
    a smaller doc_id, judged on the input. Texts that lose words become their kept words joined by one space,
    others stay as they are. A null or empty text has no words; a null doc_id is neither smaller nor larger than
    any other, so such rows stay whole; rows that share a doc_id don't count as earlier than each other.
    """
    with Scratch(docs.sparkSession, "substring") as s:
        runs = removals(docs, s, window, start)
        joined = whole_rows(docs, F.col("doc_id")).join(runs, F.col("_value") == F.col("doc_id"), "left").select("_row", "_runs")
        return s.result(joined.mapInArrow(_rewrite(window), docs.schema))


def repeat_digests(docs: DataFrame, window: int = 50, start: int = 25) -> DataFrame:
    """What :func:`remove_repeats` keeps of each document: (doc_id, n_words, n_removed, kept_sha256)."""
    with Scratch(docs.sparkSession, "substring") as s:
        runs = removals(docs, s, window, start)
        joined = docs.select("doc_id", "text").join(runs, "doc_id", "left")
        return s.result(joined.mapInArrow(_digests(window), RESULT))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digests(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM t WHERE len(ws) >= 50)),
first AS (SELECT h, min(doc_id) AS d FROM win GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN first USING (h) WHERE d < doc_id),
words AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM t),
kept AS (SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY p) AS k
         FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id)"""
