"""Spelling variants: words one edit apart, found by an index of variable-length grams.

The words of the corpus are counted first. Their grams of two to ``longest`` code points are counted
then, and pruned to a dictionary: every gram of two is in it, a longer one only if the gram without its
last code point stands at so many places that its list would not be selective. A word is decomposed into
the longest dictionary grams at its places, without those that lie inside another. For every possible
edit the grams of the word that it can affect are counted from the dictionary; the largest count bounds
how many grams any word one edit away can lack. Words one edit apart that must share two grams have two
in common among the rarest of each, two more than can be affected. Lists hold words by two such grams,
their places and the word's length; an edit leaves places as they are before it and moves those behind
it by one at most, so few lists of each word are merged. Words that meet in a list are held against
their bounds, by marks of their grams, and what passes is verified by edit distance.

Words that need not share two grams by their bounds are on lists with all of theirs. Two of those
may still share fewer, and are found by the same index over plain grams of two: a word has one more of
them than code points, and an edit affects two.
"""

from __future__ import annotations

import zlib
from itertools import combinations
from math import ceil, log2

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskwise.llm.common import held, ship, text_of

MIN_LENGTH = 6
MIN_COUNT = 5
# A form occurs so many times as often as its variant.
MORE_FREQUENT = 5
# One run of a document in so many loses a code point, by the contract.
LOSSY = 199

SHORTEST, LONGEST = 2, 3
# A gram at more places than this is extended. With more words the limit rises, so that no more than
# MOST_GRAMS grams are ever sent to the workers.
SELECTIVE = 100
MOST_GRAMS = 200_000
FIRST, LAST = "^", "$"

# Bytes of text that are searched for runs at a time, one text at least.
GROUP_BYTES = 16 << 20


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> 1), table >> 1).astype(np.uint32)
    return table


CRC = _crc_table()
# For each byte: itself, A-Z in lower case; and whether it is an ASCII letter.
LOWERED = np.frombuffer(bytes(range(256)).lower(), np.uint8)
IS_LETTER = np.array([chr(b).isalpha() and b < 128 for b in range(256)])
# U+00C0 to U+00FF are this byte and one more in UTF-8.
LEAD = 0xC3


def runs_of(texts: list[bytes], ids: list) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased runs of at least MIN_LENGTH bytes, and for each the CRC-32 of its document's id,
    a colon and the run."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    lowered = LOWERED[raw]
    letter = IS_LETTER[raw]
    lead = raw == LEAD
    letter |= lead
    letter[1:] |= lead[:-1]
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes) - sizes
    # A run starts where a letter follows none, or stands first in its text.
    starts = letter.copy()
    starts[1:] &= ~letter[:-1]
    inside = begins[(sizes > 0)]
    starts[inside] = letter[inside]
    first = np.flatnonzero(starts)
    letters = np.concatenate([[0], np.cumsum(letter, dtype=np.int64)])
    # Letters before a run, and in it.
    before = letters[first]
    length = np.diff(np.append(before, letters[-1]))
    long = length >= MIN_LENGTH
    first, length = first[long], length[long]
    doc = np.searchsorted(begins + sizes, first, side="right")
    salt = np.array([zlib.crc32(f"{'' if k is None else k}:".encode()) for k in ids], np.uint32)
    crc = _crc(lowered, first, length, salt[doc])
    take = np.repeat(first - (np.cumsum(length) - length), length) + np.arange(length.sum())
    offsets = np.append(0, np.cumsum(length)).astype(np.int64)
    runs = pa.LargeStringArray.from_buffers(
        len(first), pa.py_buffer(offsets.tobytes()), pa.py_buffer(lowered[take].tobytes())
    )
    return runs, crc


def _crc(data: np.ndarray, first: np.ndarray, length: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """CRC-32 of data[first : first + length], each continued from ``crc``, all runs a byte at a time."""
    state = ~crc
    active = np.arange(len(first))
    for k in range(64):
        active = active[length[active] > k]
        if not len(active):
            break
        now = state[active]
        state[active] = CRC[(now ^ data[first[active] + k]) & 255] ^ (now >> 8)
    out = ~state
    for k in active[length[active] > 64]:  # no usual word
        rest = data[first[k] + 64 : first[k] + length[k]].tobytes()
        out[k] = zlib.crc32(rest, int(out[k]))
    return out


def _shortened(run: str, crc: int) -> str:
    at = crc % len(run)
    return run[:at] + run[at + 1 :]


def _count_group(texts: list[bytes], ids: list) -> pa.Table:
    runs, crc = runs_of(texts, ids)
    lossy = crc % LOSSY == 0
    kept = runs.filter(pa.array(~lossy))
    short = [_shortened(r, int(c)) for r, c in zip(runs.filter(pa.array(lossy)).to_pylist(), crc[lossy], strict=True)]
    words = pa.concat_arrays([kept, pa.array(short, pa.large_string())])
    counts = words.filter(pc.greater_equal(pc.utf8_length(words), MIN_LENGTH)).value_counts()
    return pa.table({"word": counts.field(0), "n": counts.field(1)})


def _count_words(batches):
    """Counts per group of texts; Spark adds them up."""
    for batch in batches:
        ids, column = batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())
        texts, names, size = [], [], 0
        for name, text in zip(ids, column.to_pylist(), strict=True):
            texts.append(text)
            names.append(name)
            size += len(text)
            if size >= GROUP_BYTES:
                yield from _count_group(texts, names).cast(COUNTED).to_batches()
                texts, names, size = [], [], 0
        if texts:
            yield from _count_group(texts, names).cast(COUNTED).to_batches()


COUNTED = pa.schema([("word", pa.string()), ("n", pa.int64())])


def count_words(docs: DataFrame) -> DataFrame:
    """word and n of the words of at least MIN_LENGTH code points that occur MIN_COUNT times or more."""
    ship(docs.sparkSession)
    counted = docs.select("doc_id", text_of().alias("text")).mapInArrow(_count_words, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


class Grams:
    """The dictionary: grams longer than SHORTEST with the number of words' places they are found at;
    every gram of SHORTEST is in it."""

    def __init__(self, counts: dict[str, int], longest: int):
        self.counts, self.longest = counts, longest
        longer = [g for g in counts if len(g) > SHORTEST]
        self.longer = set(longer)
        self.number = {g: k for k, g in enumerate(sorted(counts))}
        # What an unseen neighbour can extend to a gram of the dictionary, and be the end of one.
        self.heads = {g[:k] for g in longer for k in range(SHORTEST, len(g))}
        self.tails = {g[-k:] for g in longer for k in range(SHORTEST, len(g))}

    def decompose(self, word: str) -> list[tuple[int, str]]:
        """Places and grams: the longest at each place, but for those within the one before."""
        text = f"{FIRST}{word}{LAST}"
        out, end = [], 0
        for p in range(len(text) - SHORTEST + 1):
            size = SHORTEST
            for more in range(min(self.longest, len(text) - p), SHORTEST, -1):
                if text[p : p + more] in self.longer:
                    size = more
                    break
            if p + size > end:
                out.append((p, text[p : p + size]))
                end = p + size
        return out

    def affected(self, word: str, grams: list[tuple[int, str]]) -> int:
        """The most grams that one edit of the word can remove or change."""
        text = f"{FIRST}{word}{LAST}"
        size, most = len(text), 0
        spans = [(p, p + len(g)) for p, g in grams]
        # Code points from ``left`` to ``right`` are replaced: one, or none where one is inserted.
        for left in range(1, size):
            # From here on, a gram that ends before the edit can grow into it, or lie in one that does.
            grown = left - 1
            for p in range(left - SHORTEST, max(-1, left - self.longest), -1):
                if text[p:left] in self.heads:
                    grown = p
            for right in (left, left + 1) if left < size - 1 else (left,):
                # Up to here, one behind the edit can lie in a gram that begins in it or before.
                covered = right + 1
                for e in range(right + SHORTEST, min(size, right + self.longest - 1) + 1):
                    if text[right:e] in self.tails:
                        covered = e
                hit = 0
                for a, b in spans:
                    if b <= left:
                        hit += a >= grown
                    elif a >= right:
                        hit += b <= covered
                    else:
                        hit += 1
                most = max(most, hit)
        return most


# What lists hold of a word. Bits: of each gram, by hash; lack: how many grams a neighbour can lack, -1 if it
# need not share two. Lists are those the word is on by its length, and those of words one shorter.
INDEXED = "word string, n long, lack int, bits long, own array<long>, shorter array<long>"
INDEX_SCHEMA = pa.schema(
    [("word", pa.string()), ("n", pa.int64()), ("lack", pa.int32()), ("bits", pa.int64()),
     ("own", pa.list_(pa.int64())), ("shorter", pa.list_(pa.int64()))]
)
SHARED = 2


def _list(one: int, place: int, other: int, further: int, length: int) -> int:
    """A list's number. Lists of words of more than 63 code points may share one."""
    number = (one << 18 | other) << 18
    return (number | (place & 63) << 12 | (further & 63) << 6 | length & 63) & (1 << 63) - 1


def lists_of(grams: Grams, word: str) -> tuple[list[int], list[int], int, int]:
    """The word's lists, those of its neighbours one shorter, lack and bits."""
    found = grams.decompose(word)
    lack = grams.affected(word, found)
    bits = 0
    for _, gram in found:
        bits |= 1 << (zlib.crc32(gram.encode()) & 63)
    if bits >> 63:
        bits -= 1 << 64
    count, number, length = grams.counts.get, grams.number, len(word)
    rare = sorted(found, key=lambda at: (count(at[1], 0), at[1], at[0]))[: lack + SHARED]
    placed = sorted((p, number.get(g, 0)) for p, g in rare)
    own, shorter = [], []
    for (p, one), (q, other) in combinations(placed, SHARED):
        own.append(_list(one, p, other, q, length))
        # The code point too many stands behind both, between them or before both.
        shorter += [_list(one, p - a, other, q - b, length - 1) for a, b in ((0, 0), (0, 1), (1, 1))]
    return own, shorter, lack if lack + SHARED <= len(found) else -1, bits


def _index(dictionary):
    """Words with the lists they are on."""

    def run(batches):
        grams: Grams = dictionary.value
        for batch in batches:
            each = [lists_of(grams, word) for word in batch.column(0).to_pylist()]
            own, shorter, lack, bits = zip(*each, strict=True) if each else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lack, pa.int32()), pa.array(bits, pa.int64()),
                 pa.array(own, pa.list_(pa.int64())), pa.array(shorter, pa.list_(pa.int64()))],
                schema=INDEX_SCHEMA,
            )

    return run


def gram_counts(words: DataFrame, longest: int) -> DataFrame:
    """gram and n: at how many places of the words it stands."""
    padded = words.select(F.concat(F.lit(FIRST), "word", F.lit(LAST)).alias("text"))
    each = [
        F.transform(F.sequence(F.lit(1), F.length("text") - (size - 1)), lambda p, size=size: F.substring("text", p, size))
        for size in range(SHORTEST, longest + 1)
    ]
    return padded.select(F.explode(F.concat(*each)).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))


def gram_dictionary(words: DataFrame, longest: int, selective: int = SELECTIVE, most: int = MOST_GRAMS) -> Grams:
    """The pruned dictionary, of ``most`` grams longer than two at the most: with more, the limit beyond
    which a gram is extended is doubled until they are so many."""
    counts = held(gram_counts(words, longest), "grams")
    longer = counts.where(F.length("gram") > SHORTEST).withColumn("head", F.expr("left(gram, length(gram) - 1)"))
    heads = counts.select(F.col("gram").alias("head"), F.col("n").alias("head_n")).where(F.col("head_n") > selective)
    extended = longer.join(heads, "head")
    # By powers of two of the limit: a few dozen rows.
    step = F.floor(F.log2((F.col("head_n") - 1) / selective)).cast("int")
    per_step = {r.step: r.grams for r in extended.groupBy(step.alias("step")).agg(F.count("*").alias("grams")).collect()}
    limit, left = 0, sum(per_step.values())
    while left > most:
        left -= per_step.get(limit, 0)
        limit += 1
    kept = extended.where(step >= limit).select("gram", "n")
    shortest = counts.where(F.length("gram") == SHORTEST).select("gram", "n")  # letters squared at most
    return Grams({r.gram: r.n for r in kept.unionByName(shortest).collect()}, longest)


def _pairs(indexed: DataFrame) -> DataFrame:
    """Pairs of words one edit apart, once for each list they meet on."""
    entry = F.struct("word", "n", "bits", "lack").alias("entry")
    own = indexed.select(entry, F.explode("own").alias("list"))
    longer = indexed.select(entry, F.explode("shorter").alias("list"), F.lit(True).alias("longer"))
    met = own.withColumn("longer", F.lit(False)).unionByName(longer)
    a, b = own.alias("a"), met.alias("b")
    x, y = F.col("a.entry"), F.col("b.entry")

    def lacking(one, other):
        missing = F.bit_count(one["bits"].bitwiseAND(F.bitwise_not(other["bits"])))
        return (one["lack"] < 0) | (missing <= one["lack"])

    near = (
        (F.col("a.list") == F.col("b.list"))
        & (F.col("b.longer") | (x["word"] < y["word"]))
        & lacking(x, y) & lacking(y, x)
        & (F.levenshtein(x["word"], y["word"], 1) == 1)
    )
    return a.join(b, near).select(
        x["word"].alias("a"), x["n"].alias("a_n"), y["word"].alias("b"), y["n"].alias("b_n")
    )


def near_words(words: DataFrame, longest: int = LONGEST, selective: int = SELECTIVE) -> DataFrame:
    """a, a_n, b, b_n: each pair of words exactly one edit apart, once. ``words`` (word, n) is stored."""
    spark = words.sparkSession
    grams = gram_dictionary(words, longest, selective)
    dictionary = spark.sparkContext.broadcast(grams)
    indexed = held(words.select("word", "n").mapInArrow(_index(dictionary), INDEXED), "gram-index")
    plain = spark.sparkContext.broadcast(
        Grams({g: n for g, n in grams.counts.items() if len(g) == SHORTEST}, SHORTEST)
    )
    unbound = indexed.where("lack < 0").select("word", "n").mapInArrow(_index(plain), INDEXED)
    return _pairs(indexed).unionByName(_pairs(unbound)).distinct()


def longest_chain(most: int) -> int:
    """The most forms that follow one another up to a word that occurs ``most`` times, one at least."""
    steps, n = 0, MIN_COUNT * MORE_FREQUENT
    while n <= most:
        steps, n = steps + 1, n * MORE_FREQUENT
    return max(1, steps)


def _with_roots(forms: DataFrame, most: int) -> DataFrame:
    """word and root of the words that have a form, by following two, four, eight ... forms at a time. On
    the way n grows MORE_FREQUENT-fold with each form, so the longest way follows from the largest n."""
    reached = held(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(ceil(log2(longest_chain(most)))):
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        reached = held(
            reached.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots"
        )
    return reached


def spelling_variants(docs: DataFrame, longest: int = LONGEST, selective: int = SELECTIVE) -> DataFrame:
    """Words of the corpus with the more frequent spelling each is a variant of.

    Returns word, n, n_near (words one edit apart), form and form_n (the most frequent of those, the first
    in code-point order among equals, if it occurs at least five times as often; else null) and root
    (where following forms ends; the word itself without a form).

    A null or empty text has no words, a null doc_id stands as nothing before the colon of the hashed
    key, and rows that repeat a document count again, as do all occurrences. No words: no rows. Columns
    other than doc_id and text are not read.
    """
    words = held(count_words(docs), "words")
    pairs = near_words(words, longest, selective)
    each = F.array(
        F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
    )
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    beside = (
        pairs.select(F.inline(each)).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    )
    form = F.col("best.near")
    form_n = -F.col("best.less")
    enough = form_n >= MORE_FREQUENT * F.col("n")
    found = held(
        words.join(beside, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(enough, form).alias("form"), F.when(enough, form_n).alias("form_n"),
        ),
        "variants",
    )
    most = words.agg(F.max("n")).first()[0] or 0
    roots = _with_roots(found.where(F.col("form").isNotNull()), most)
    return found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word")).select(
        "word", "form", "root", "n", "n_near", "form_n"
    )
