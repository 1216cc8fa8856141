"""Quality rules: word statistics and zstandard compression bands over whole texts and fixed chunks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm.common import table, whole_rows
from panelwright.llm.words import SLICE_BYTES, Words, covered, slices, windows

CHUNK = 4096             # bytes of a fixed chunk; the last one of a text may be shorter
LEAST = 256              # a last chunk below this size says little: it is judged as part of the one before it
LEVEL = 3

# (size up to, lowest ratio, highest ratio) of original to compressed bytes. Longer texts share more, so the band moves up
# with the size. Below the band a text is incompressible (random strings, encoded data), above it repetitive.
BANDS = ((255, 1.2, 2.6), (512, 1.15, 2.9), (1024, 1.25, 3.3), (2048, 1.4, 3.6), (4096, 1.5, 4.2), (16384, 1.6, 5.0), (65536, 1.7, 6.0),
         (float("inf"), 1.7, 8.0))
CHUNK_BANDS = BANDS[:5]
BAD_CHUNKS = 0.3         # share of a text's judged chunks outside their band from which the text goes

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_BLANK = b" \t\n\x0b\x0c\r"

FIELDS = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
          ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("ratio", pa.float64()),
          ("n_chunks", pa.int64()), ("n_bad_chunks", pa.int64())]
STRUCT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
          "kept boolean, ratio double, n_chunks long, n_bad_chunks long")


def band(size: int, bands=BANDS) -> tuple[float, float]:
    return next((lo, hi) for most, lo, hi in bands if size <= most)


def ratio(press: zstandard.ZstdCompressor, data: bytes) -> float:
    return len(data) / len(press.compress(data))


def _compression(press: zstandard.ZstdCompressor, data: bytes) -> tuple[float | None, int, int, bool]:
    """Whole-text ratio, chunks, chunks outside their band, and whether the text passes both rules. An empty text has no ratio and passes."""
    if not data:
        return None, 0, 0, True
    whole = ratio(press, data)
    low, high = band(len(data))
    passes = low <= whole <= high
    judged = bad = 0
    if len(data) > CHUNK:
        ends = [*range(CHUNK, len(data), CHUNK), len(data)]
        if ends[-1] - ends[-2] < LEAST:
            del ends[-2]
        for at, end in zip([0, *ends], ends, strict=False):
            low, high = band(min(end - at, CHUNK), CHUNK_BANDS)
            judged += 1
            bad += not low <= ratio(press, data[at:end]) <= high
    return whole, judged, bad, passes and bad < max(1, BAD_CHUNKS * judged)


def _repeated_words(w: Words, size: int = 3) -> np.ndarray:
    """Per row, the words inside a window of ``size`` words that occurs twice or more in that row."""
    h = windows(w.hashes(), size)
    at = np.flatnonzero(w.in_row(size)[:len(h)])
    row = w.rows()[at]
    order = np.lexsort((h[at], row))
    r, v = row[order], h[at][order]
    same = (r[1:] == r[:-1]) & (v[1:] == v[:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    hit = covered(len(w), np.sort(at[order[twice]]), size)
    return np.diff(np.append(0, np.cumsum(hit))[w.first])


def _line_repeats(text: bytes) -> int:
    seen: set[bytes] = set()
    repeats = 0
    for line in text.split(b"\n"):
        if line.strip(_BLANK):
            repeats += line in seen
            seen.add(line)
    return repeats


def _judge(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    press = zstandard.ZstdCompressor(level=LEVEL)
    for column in texts:
        parts = []
        for a, e, raw, off in slices(column, SLICE_BYTES):
            w = Words(raw, off)
            count = w.counts()
            letter = np.append(0, np.cumsum(w.inside & ((raw & 0xC0) != 0x80)))
            symbol = np.append(0, np.cumsum(_SYMBOL[raw]))
            repeat = _repeated_words(w)
            data = [raw[off[i]:off[i + 1]].tobytes() for i in range(e - a)]
            failed = (count < 50) | (100 * repeat > 50 * count)
            packed = [_compression(press, x) for x in data]
            columns = [count, np.diff(letter[off]), np.diff(symbol[off]), [_line_repeats(x) for x in data], repeat, failed,
                       ~failed & np.array([p[3] for p in packed], bool), [p[0] for p in packed], [p[1] for p in packed],
                       [p[2] for p in packed]]
            parts.append(pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, FIELDS, strict=True)],
                                                    [n for n, _ in FIELDS]))
        yield pa.concat_arrays(parts) if parts else pa.array([], pa.struct(FIELDS))


def judged(text: Column) -> Column:
    """The rules of one text as a struct. A null or empty text has no words and fails the base rules."""
    return F.arrow_udf(_judge, STRUCT).asNondeterministic()(text)


def quality_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, ratio, n_chunks, n_bad_chunks).

    Every row is judged alone, so repeated rows, null ids and extra columns need no care; the latter are not read.
    """
    return docs.select("doc_id", judged(F.col("text")).alias("_q")).select("doc_id", "_q.*")


def passing(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns.

    Null and empty texts fail the base rules and go; rows are judged one by one, so repeated rows stay or go together, null ids change nothing, and
    columns of any other name are kept as they are. An empty table stays empty.
    """
    return whole_rows(docs, judged(F.col("text"))).where("_value.kept").select("_row.*")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"))
