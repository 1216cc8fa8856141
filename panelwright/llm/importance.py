"""Importance resampling towards a target distribution: hashed n-gram gains, Gumbel noise, an exact distributed top share."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm.common import Scratch, numbered, table
from panelwright.llm.words import filled, text_slices

LONGEST = 1              # words of the longest n-gram
BUCKETS = 10_000
LEAST_WORDS, PERCENT, SEED = 20, 10, 2024
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"     # what is left between words once A-Z are lower case
BIN = 1000               # scores of one bin of the search for the cut


def grams(column: pa.Array, longest: int, buckets: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per run of rows: (first row, end row, words of each row, row of each n-gram, bucket of each n-gram).

    Words are dictionary-encoded, so each distinct word is hashed once. A longer n-gram is a pair of a distinct shorter one and the word that
    follows it; each distinct pair continues the shorter one's CRC over a space and the word. The dictionaries live for one slice.
    """
    column = filled(column)
    for a, e in text_slices(column):
        parts = pc.split_pattern_regex(pc.ascii_lower(column.slice(a, e - a)), SEPARATORS)
        words, row = pc.list_flatten(parts), pc.list_parent_indices(parts)
        real = pc.not_equal(words, "")
        code = pc.filter(words, real).dictionary_encode()
        row = pc.filter(row, real).to_numpy()
        text = [w.encode() for w in code.dictionary.to_pylist()]
        word = code.indices.to_numpy()
        gram, crc = word, np.fromiter(map(zlib.crc32, text), np.int64, len(text))
        rows, found = [row], [(crc % buckets)[gram]]
        for n in range(2, longest + 1):
            inside = row[n - 1:] == row[:max(0, len(row) - n + 1)]                 # ends in the row in which it starts
            pair = gram[:len(inside)].astype(np.int64) * max(1, len(text)) + word[n - 1:]
            pair, place = np.unique(pair[inside], return_inverse=True)
            shorter, last = np.divmod(pair, max(1, len(text)))
            crc = np.fromiter((zlib.crc32(b" " + text[w], c) for c, w in zip(crc[shorter].tolist(), last.tolist(), strict=True)), np.int64, len(pair))
            gram = np.zeros(len(inside), np.int64)                                 # where none starts, no longer one starts either
            gram[inside] = place
            rows.append(row[:len(inside)][inside])
            found.append((crc % buckets)[place])
        yield a, e, np.bincount(row, minlength=e - a), np.concatenate(rows), np.concatenate(found)


def _counts(longest: int, buckets: int):
    """Features by bucket, one row a used bucket at the end of each partition."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in stream:
            for *_, bucket in grams(batch.column("text"), longest, buckets):
                total += np.bincount(bucket, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], ["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """Features of all texts by bucket; ``buckets`` rows reach the driver."""
    found = texts.select("text").mapInArrow(_counts(longest, buckets), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out


def bucket_gains(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """floor(1000 ln(how much likelier a bucket is in the target)), each bucket counted once more than it was seen."""
    b, t, s = float(len(raw)), float(target.sum()), float(raw.sum())
    return np.array([math.floor(1000 * math.log((x + 1.0) * (s + b) / ((y + 1.0) * (t + b)))) for x, y in zip(target.tolist(), raw.tolist(), strict=True)], np.int64)


def _weights(longest: int, buckets: int, gains):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for a, e, words, row, bucket in grams(batch.column("text"), longest, buckets):
                order = np.argsort(row, kind="stable") if longest > 1 else slice(None)
                gain, n = gains.value[bucket][order], np.bincount(row, minlength=e - a)
                full = np.flatnonzero(n)
                total = np.zeros(e - a, np.int64)
                if len(full):
                    total[full] = np.add.reduceat(gain, (np.cumsum(n) - n)[full])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, e - a), pa.array(words.astype(np.int64)), pa.array(n.astype(np.int64)),
                                                  pa.array(total // np.maximum(n, 1))], ["doc_id", "n_words", "n_features", "weight"])

    return run


def cut_score(rows: DataFrame, wanted: int) -> int | None:
    """The lowest score among the ``wanted`` highest of ``rows`` (score), found by bins and then within one; None for no rows.

    A bin for every ``BIN`` scores reaches the driver, then the scores of one bin; scores are whole numbers of a range that
    no amount of rows widens.
    """
    if wanted <= 0:
        return None
    for by, part in ((F.floor(F.col("score") / BIN), lambda r: F.floor(F.col("score") / BIN) == r), (F.col("score"), None)):
        for value, n in sorted(((r["value"], r["count"]) for r in rows.groupBy(by.alias("value")).count().collect()), reverse=True):
            if n >= wanted:
                break
            wanted -= n
        rows = rows.where(part(value)) if part else rows
    return value


def resample(docs: DataFrame, target: DataFrame, s: Scratch, longest: int = LONGEST, buckets: int = BUCKETS, least_words: int = LEAST_WORDS,
             percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of each row of ``docs`` (doc_id, text), ``target`` holding texts (text).

    A null or empty text has no words, weight 0 and a score, and is never drawn; nor is any text below ``least_words``. The draw is
    exact: a score at which the wanted number is reached is found from counts, the rows from there on are sorted by range over tasks, and
    each takes its place after the rows of the ranges before. Equal scores go to the smaller doc_id, null ids last; rows that repeat an id have one noise,
    and count each. A doc_id that is null has the noise of the empty id. No rows, an empty target: an empty result, gains of an empty target.
    """
    spark = docs.sparkSession
    gains = spark.sparkContext.broadcast(bucket_gains(bucket_counts(target, longest, buckets), bucket_counts(docs, longest, buckets)))
    weighed = docs.select("doc_id", "text").mapInArrow(_weights(longest, buckets, gains), "doc_id long, n_words long, n_features long, weight long")
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(drawn, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log(share)))
    scored = s.store(weighed.withColumn("score", F.col("weight") + noise))
    fit = F.col("n_words") >= least_words
    wanted = percent * scored.where(fit).count() // 100
    least = cut_score(scored.where(fit).select("score"), wanted)
    if least is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    ahead = fit & (F.col("score") >= least)
    placed = numbered(scored.where(ahead), s, F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    rank = F.when(F.col("_place") < wanted, F.col("_place") + 1)
    return placed.withColumn("rank", rank).drop("_place").unionByName(scored.where(~ahead).withColumn("rank", F.lit(None).cast("long")))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Scratch(spark, "importance") as s:
        drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), s)
        return s.result(drawn.select("doc_id", "n_features", "weight", "score", "rank"))


# The checksum bit by bit for its 256 table entries, then byte by byte over each distinct word.
OP12_SQL = rf"""
WITH RECURSIVE bits AS (SELECT i, 0 AS step, i AS c FROM range(256) AS t(i) UNION ALL
  SELECT i, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE step < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS entries FROM bits WHERE step = 8),
texts AS (SELECT 0 AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
split AS MATERIALIZED (SELECT kind, id, row_number() OVER () AS r, regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM texts),
words AS MATERIALIZED (SELECT kind, r, unnest(ws) AS w FROM split),
vocabulary AS MATERIALIZED (SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen(w)),
    lambda i: CAST('0x' || substr(hex(encode(w)), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
    lambda acc, b: xor(acc >> 8, entries[(xor(acc, b) & 255) + 1])), 4294967295) % {BUCKETS} AS bucket
  FROM (SELECT DISTINCT w FROM words), crc),
counts AS (SELECT bucket, count(*) FILTER (kind = 0) AS s, count(*) FILTER (kind = 1) AS t FROM words JOIN vocabulary USING (w) GROUP BY bucket),
totals AS (SELECT sum(s)::DOUBLE AS s, sum(t)::DOUBLE AS t FROM counts),
gains AS (SELECT bucket, floor(1000 * ln((c.t + 1.0::DOUBLE) * (totals.s + {BUCKETS}) / ((c.s + 1.0::DOUBLE) * (totals.t + {BUCKETS}))))::BIGINT AS gain
  FROM counts c, totals),
sums AS (SELECT r, count(*) AS n, sum(gain)::BIGINT AS g FROM words JOIN vocabulary USING (w) JOIN gains USING (bucket) WHERE kind = 0 GROUP BY r),
scored AS (SELECT id AS doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce((g - ((g % n) + n) % n) // n, 0)::BIGINT AS weight,
    CAST('0x' || substr(sha256('{SEED}:' || id), 1, 8) AS BIGINT) AS h FROM split LEFT JOIN sums USING (r) WHERE kind = 0),
noised AS (SELECT doc_id, n_features, weight, (weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score FROM scored),
placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM noised WHERE n_features >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {PERCENT} * n // 100 THEN place END AS rank
FROM noised LEFT JOIN placed USING (doc_id)"""
