"""Repeated passages removed by hashing lines.

A unit is a line; lines are cut further where a sentence ends and before a capital letter, so that a
passage pasted into the middle of a line is still made of whole units. Units are normalised (lower
case, no ASCII punctuation, single spaces) and hashed to 128 bits. Every line of a text of several is
hashed whole, however short. A piece of a line of fewer than MIN_WORDS words is hashed together with as
many of the next ones as it takes to reach them, and with as many of those before it, as short sentences
recur by chance. Digests are grouped globally. The occurrence that ranks first (smallest doc_id, then place)
stays, the spans of all others are removed, and their offsets in the original text are kept.

Every removed word stands in an earlier occurrence of the same unit, line or joined units, by rank. A
passage of several units is not left in one piece for that: if document 1 holds line X, and 2 and 3 hold X and
then Y, X stays in 1 and Y in 2.
"""

from __future__ import annotations

import re
import string

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskwise.llm.common import arrow_schema, by_size, column, held, row_key, ship, text_of, typed

MIN_WORDS = 8
# Bytes of text that are cut at a time.
CUT_BYTES = 4 << 20
SPACES = " \t\n\r\x0b\x0c"
CUT = re.compile(r"\n|(?<=[.!?])[ \t\r\x0b\x0c]+|(?<=[^\s.!?]) (?=[A-ZÀ-ÖØ-ÞΑ-ΩА-Я])")
NO_PUNCTUATION = {ord(c): None for c in string.punctuation}

OCCURRENCE = "high long, low long, key_id long, key_text long, begin int, until int"
# Rows without an id rank behind all others.
LAST_ID = (1 << 63) - 1


def units(text: str) -> list[tuple[int, int, list[str], int]]:
    """Begin, end, normalised words and line of each unit that has any; offsets count code points.

    What stands before the first word of a line belongs to that line's first unit.
    """
    found, begin, line, head = [], 0, 0, True
    plain = text.lower()
    if len(plain) != len(text):  # a few letters grow in lower case; then offsets would not fit
        plain = "".join(low if len(low := c.lower()) == 1 else c for c in text)
    for end, after in [*(m.span() for m in CUT.finditer(text)), (len(text), len(text))]:
        words = plain[begin:end].translate(NO_PUNCTUATION).split()
        if words:
            found.append((begin, end, words, line))
            head = False
        if text[end:after] == "\n":
            begin, line, head = after, line + 1, True
        elif not head:
            begin = after
    return found


def occurrences(text: str, min_words: int = MIN_WORDS) -> list[tuple[int, int, int, int]]:
    """(high, low, begin, end) of each line and unit, by begin, the longest first.

    Short units are joined with those that follow, and once more with those before them. The line of a
    text that has only one counts as any other unit: such a text is no boilerplate of another.
    """
    own, found = units(text), set()
    several = "\n" in text

    def add(first: int, last: int) -> None:
        words = [w for u in own[first : last + 1] for w in u[2]]
        found.add((xxhash.xxh3_128_intdigest(" ".join(words)), own[first][0], own[last][1]))

    head = 0
    for k, (_, _, words, line) in enumerate(own):
        last, n = k, len(words)
        while n < min_words and last + 1 < len(own):
            last += 1
            n += len(own[last][2])
        if n >= min_words:
            add(k, last)
        first, n = k, len(words)
        while n < min_words and first:
            first -= 1
            n += len(own[first][2])
        if first < k and n >= min_words:
            add(first, k)
        if several and (k + 1 == len(own) or own[k + 1][3] != line):
            add(head, k)
            head = k + 1
    spans = sorted(found, key=lambda f: (f[1], -f[2]))
    return [(number >> 64, number & (1 << 64) - 1, begin, end) for number, begin, end in spans]


def _occurrences(min_words: int, schema: pa.Schema):
    def run(batches):
        for batch in (part for whole in batches for part in by_size(whole, 2, CUT_BYTES)):
            rows, found = [], []
            for k, text in enumerate(batch.column(2).to_pylist()):
                each = occurrences(text, min_words)
                found += each
                rows += [k] * len(each)
            high, low, begin, end = zip(*found, strict=True) if found else ((), (), (), ())
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(high, np.uint64).view(np.int64)), pa.array(np.array(low, np.uint64).view(np.int64)),
                 batch.column(0).take(at), batch.column(1).take(at),
                 pa.array(begin, pa.int32()), pa.array(end, pa.int32())],
                schema=schema,
            )

    return run


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """key_id, key_text, begin and until of every occurrence that is not the first of its digest.

    Digests are reduced map-side to their first occurrence and count, so one that a third of all
    documents hold is a few rows of that shuffle; only digests that occur twice are joined back, and
    adaptive execution splits a skewed one.
    """
    ship(docs.sparkSession)
    schema = typed(OCCURRENCE)
    key_id, key_text = row_key()
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("key_id"), key_text, text_of().alias("text")
    )
    # Rows equal in id and text are one document.
    # Written once and read twice: texts are cut and hashed a single time.
    found = held(keyed.mapInArrow(_occurrences(min_words, arrow_schema(schema)), schema), "occurrences")
    rank = F.struct("key_id", "key_text", "begin")
    # Written out, so that it is a plain side of the join, whose skewed partitions can then be split.
    first = held(
        found.groupBy("high", "low")
        .agg(F.min(rank).alias("first"), F.max(rank).alias("last"))
        .where("first != last")
        .select("high", "low", "first"),
        "repeated-digests",
    )
    later = found.join(first, ["high", "low"]).where(rank != F.col("first"))
    return later.select("key_id", "key_text", "begin", "until").distinct()


def cut_spans(text: str, spans: list[tuple[int, int]]) -> tuple[str, list[tuple[int, int]]]:
    """The text without the spans and the white space behind them, and what was removed."""
    removed: list[list[int]] = []
    for begin, end in sorted(spans):
        while end < len(text) and text[end] in SPACES:
            end += 1
        if removed and begin <= removed[-1][1]:
            removed[-1][1] = max(removed[-1][1], end)
        else:
            removed.append([begin, end])
    kept, at = [], 0
    for begin, end in removed:
        kept.append(text[at:begin])
        at = end
    return "".join([*kept, text[at:]]), [(a, b) for a, b in removed]


def _apply(schema: pa.Schema, text_at: int):
    """Rows whose last column lists spans to rows with the text cut and what was removed."""

    def run(batches):
        for batch in batches:
            columns = list(batch.columns)
            spans = columns.pop()
            if spans.null_count == len(spans):
                removed = pa.array([[]] * len(spans), schema.field(len(schema) - 1).type)
            else:
                texts, each = columns[text_at].to_pylist(), spans.to_pylist()
                cut = [
                    cut_spans(t, [(s["begin"], s["until"]) for s in own]) if own else (t, [])
                    for t, own in zip(texts, each, strict=True)
                ]
                columns[text_at] = pa.array([t for t, _ in cut], schema.field(text_at).type)
                removed = pa.array(
                    [[{"begin": a, "until": b} for a, b in r] for _, r in cut], schema.field(len(schema) - 1).type
                )
            yield pa.RecordBatch.from_arrays([*columns, removed], schema=schema)

    return run


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS, removed: str = "removed") -> DataFrame:
    """All rows and columns of ``docs``, text without passages that occur earlier, and a last column
    that lists what was removed: begin and until in code points of the original text.

    The removed ranges, cut out of the original text, give the returned one. Null and empty texts are
    returned as they are. Rows equal in doc_id and text are one document occurring several times and
    are all cut alike; rows without an id rank last, by a hash of their texts. A column of the name
    ``removed`` in the input is replaced; doc_id must be an integer.
    """
    spans = repeated_spans(docs, min_words)
    lists = spans.groupBy("key_id", "key_text").agg(
        F.collect_list(F.struct("begin", "until")).alias("spans")  # as many as a document has units
    )
    columns = [c for c in docs.columns if c.lower() != removed.lower()]
    # Columns go by their places, so that no name of the caller's can meet one of ours.
    places = [f"c{k}" for k in range(len(columns))]
    row_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("row_id")
    rows = docs.select(
        *[column(c).alias(p) for c, p in zip(columns, places, strict=True)], row_id, row_key()[1].alias("row_text")
    )
    same = (rows["row_id"] == lists["key_id"]) & (rows["row_text"] == lists["key_text"])
    joined = rows.join(lists, same, "left").select(*places, "spans")
    spans = T.StructField("removed", typed("s array<struct<begin: int, until: int>>")["s"].dataType)
    schema = T.StructType([*joined.schema.fields[:-1], spans])
    text_at = [c.lower() for c in columns].index("text")
    return joined.mapInArrow(_apply(arrow_schema(schema), text_at), schema).toDF(*columns, removed)
