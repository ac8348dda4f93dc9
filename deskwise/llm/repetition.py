"""Repetition coverage: how much of a text lies in n-grams and lines that occur more than once.

Words become small integers, n-grams of growing length become 64-bit rolling hashes of them (the hash
of n words is that of the first n - 1, times a constant, plus the next word's), and sorting the hashes
of a text tells which occur again. Everything about a text is found in one pass over it; nothing is
shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskwise.llm.common import arrow_schema, ship, text_of, typed

# Highest shares, in hundredths, of a text's word characters. Fixed values, from published filters.
MOST_IN_TOP_NGRAM = {2: 20, 3: 18, 4: 16}
MOST_IN_REPEATED_NGRAMS = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
MOST_LINE_CHARS = 20
# Of the lines that hold a word.
MOST_LINES = 30
MIN_WORDS = 50
MOST_REPEAT_WORDS = 50

SYMBOLS = b"#*$%&|<>"
_BASE = np.uint64(0x9E3779B97F4A7C15)

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "dup_line_chars", "n_repeat_words",
    *(f"top_{n}_chars" for n in MOST_IN_TOP_NGRAM),
    *(f"repeated_{n}_chars" for n in MOST_IN_REPEATED_NGRAMS),
)


def _mixed(codes: np.ndarray) -> np.ndarray:
    """Small integers to well spread 64-bit ones."""
    x = (codes.astype(np.uint64) + np.uint64(1)) * _BASE
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _covered(repeated: np.ndarray, n: int, words: int) -> np.ndarray:
    """Which words lie in a repeated window of n words."""
    edges = np.zeros(words + 1, np.int64)
    first = np.flatnonzero(repeated)
    np.add.at(edges, first, 1)
    np.add.at(edges, first + n, -1)
    return np.cumsum(edges[:-1]) > 0


def _repeated(windows: np.ndarray) -> np.ndarray:
    """Which windows occur twice or more, the first occurrence included."""
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    return counts[inverse] > 1


def measure(text: str) -> tuple[int, ...]:
    """The MEASURES of a text."""
    data = text.encode()
    words = data.split()
    number: dict[bytes, int] = {}
    codes = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    length_of = np.array([len(w.decode()) for w in number], np.int64)
    lengths = length_of[codes] if len(codes) else np.zeros(0, np.int64)

    seen, lines, dup_lines, dup_line_chars = set(), 0, 0, 0
    for line in data.split(b"\n"):
        own = line.split()
        if not own:
            continue
        lines += 1
        if line in seen:
            dup_lines += 1
            dup_line_chars += sum(len(w.decode()) for w in own)
        seen.add(line)

    n_words = len(words)
    mixed, rolling = _mixed(codes), np.zeros(n_words, np.uint64)
    ends = np.concatenate([[0], np.cumsum(lengths)])
    top, repeated_chars, repeat_words, any_repeat = {}, {}, 0, True
    for n in range(1, max(MOST_IN_REPEATED_NGRAMS) + 1):
        if n > n_words:
            break
        rolling = rolling[: n_words - n + 1] * _BASE + mixed[n - 1 :]
        if n == 3:
            # Not left to a hash: the windows themselves, numbered by their pairs.
            pairs = np.unique(codes[:-1] * len(number) + codes[1:], return_inverse=True)[1]
            exact = pairs[:-1] * len(number) + codes[2:]
            repeat_words = int(_covered(_repeated(exact), 3, n_words).sum())
        if n in MOST_IN_TOP_NGRAM:
            _, first, counts = np.unique(rolling, return_index=True, return_counts=True)
            most = counts.max()
            if most > 1:
                at = first[counts == most]
                top[n] = int(most * (ends[at + n] - ends[at]).max())
        if n in MOST_IN_REPEATED_NGRAMS:
            again = _repeated(rolling)
            if not again.any():  # then no longer window occurs again either
                break
            repeated_chars[n] = int(lengths[_covered(again, n, n_words)].sum())
    return (
        n_words, int(lengths.sum()), len(data) - len(data.translate(None, SYMBOLS)), lines, dup_lines,
        dup_line_chars, repeat_words,
        *(top.get(n, 0) for n in MOST_IN_TOP_NGRAM),
        *(repeated_chars.get(n, 0) for n in MOST_IN_REPEATED_NGRAMS),
    )


def _measure(schema: pa.Schema):
    def run(batches):
        for batch in batches:
            rows = [measure(text) for text in batch.column(len(batch.schema) - 1).to_pylist()]
            columns = zip(*rows, strict=True) if rows else [[] for _ in MEASURES]
            arrays = [pa.array(c, pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], schema=schema)

    return run


def repetition(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id, the MEASURES of every whole text, base_failed and kept.

    A null or empty text has no words: it fails the base rules. kept is false for a text that fails
    them, or of whose word characters too many lie in its most frequent 2-, 3- or 4-gram, in repeated
    5- to 10-grams or in repeated lines, or of whose lines too many are repeated. Among the most
    frequent n-grams the longest counts. A row is judged by itself, so ids may repeat or be null.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()
    schema = typed(f"`{id_column}` {kind}, " + ", ".join(f"{m} long" for m in MEASURES))
    rows = docs.select(id_column, text_of(text_column).alias("text"))
    measured = rows.mapInArrow(_measure(arrow_schema(schema)), schema)
    base = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEAT_WORDS * F.col("n_words")
    )
    chars = F.col("word_chars")
    limits = {f"top_{n}_chars": k for n, k in MOST_IN_TOP_NGRAM.items()}
    limits |= {f"repeated_{n}_chars": k for n, k in MOST_IN_REPEATED_NGRAMS.items()}
    limits["dup_line_chars"] = MOST_LINE_CHARS
    verdict = 100 * F.col("n_dup_lines") <= MOST_LINES * F.col("n_lines")
    for name, most in limits.items():
        verdict &= 100 * F.col(name) <= most * chars
    return measured.withColumns({"base_failed": base}).withColumn("kept", ~F.col("base_failed") & verdict)
