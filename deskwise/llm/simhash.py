"""SimHash near-duplicates by a byte-position inverted index.

Two 64-bit fingerprints that differ in at most two bits differ in at most two of their eight bytes,
so they share at least six positional bytes. That guaranteed minimum of matches is what the index is
keyed by: a posting list holds the distinct fingerprints that agree in the bytes of six positions,
one list for each of the 28 choices of six. Pairs reach the tally of six exactly if they meet in a
list. Members of a list can only differ in their two other bytes, so no list ever exceeds 65,536
entries, whatever the corpus holds, and is a block that a task can hold. Candidates of a block are looked
up, by the 136 patterns of one and two bits, without comparing all of its pairs; the equal positional bytes
of each candidate are tallied, those of six or more are retained and verified bit by bit. A list hands on a
spanning star per group of linked entries; repeated labelling over the stars gives the components.

Copies share a fingerprint and are one entry of the index, however many there are.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskwise.llm.common import arrow_schema, held, rank_struct, row_key, ship, text_of, typed, whole_rows

SHINGLE_WORDS = 3
MOST_BITS = 2
SEED = 42
# Bits of so many shingles are tallied at a time.
TALLY = 1 << 16

# Fingerprints that a task makes index entries of, 28 each.
TASK_FINGERPRINTS = 1 << 14

BYTES = 8
SHARED = BYTES - MOST_BITS
#: The positions, from the lowest byte, that the members of a kind of list may differ in.
FREE = list(combinations(range(BYTES), BYTES - SHARED))


def fingerprint(text: str, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """A bit is set if it is set in over half of the shingles' hashes; no words: zero."""
    words = text.encode().lower().split()  # bytes: only A-Z change, only the six spaces split
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.array([len(w) for w in words])
    begin = np.cumsum(lengths + 1) - lengths - 1
    end = begin + lengths
    n = max(1, len(words) - words_per_shingle + 1)
    last = end[min(words_per_shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[a:b], SEED) for a, b in zip(begin[:n].tolist(), last.tolist(), strict=True)], "<u8"
    )
    counts = np.zeros(64, np.int64)
    for k in range(0, n, TALLY):
        bits = np.unpackbits(hashes[k : k + TALLY].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << k for k in np.flatnonzero(2 * counts > n).tolist()))


def _fingerprints(words_per_shingle: int, schema: pa.Schema):
    def run(batches):
        for batch in batches:
            found = [fingerprint(t, words_per_shingle) for t in batch.column(len(batch.schema) - 1).to_pylist()]
            values = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(values)], schema=schema)

    return run


def fingerprints(docs: DataFrame, keys: list[Column], words_per_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """The keys and the fingerprint (as a signed long) of every whole text; a null text is empty."""
    ship(docs.sparkSession)
    rows = docs.select(*keys, text_of().alias("shingled"))
    fields = [f for f in rows.schema.fields if f.name != "shingled"]
    schema = typed(", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", fingerprint long")
    return rows.mapInArrow(_fingerprints(words_per_shingle, arrow_schema(schema)), schema)


def _mask(free: tuple[int, ...]) -> int:
    """All bits but those of the free bytes, as a signed long."""
    value = (1 << 64) - 1
    for k in free:
        value &= ~(0xFF << 8 * k)
    return value - (1 << 64) if value >> 63 else value


def posting_lists(distinct: DataFrame) -> DataFrame:
    """positions, shared (the bytes all members agree in) and members (their two free bytes as one
    number), for lists of two members or more."""
    keys = [
        F.struct(
            F.lit(n).alias("positions"),
            F.col("fingerprint").bitwiseAND(F.lit(_mask(free))).alias("shared"),
            reduce(
                lambda a, b: a * 256 + b,
                [F.shiftrightunsigned("fingerprint", 8 * k).bitwiseAND(0xFF) for k in free],
            ).cast("int").alias("rest"),
        )
        for n, free in enumerate(FREE)
    ]
    return (
        distinct.select(F.inline(F.array(*keys)))
        .groupBy("positions", "shared")
        .agg(F.collect_list("rest").alias("members"))  # 65,536 at most
        .where(F.size("members") > 1)
    )


def _nearby(bits: int) -> list[int]:
    one = [1 << a for a in range(8 * MOST_BITS)]
    return [reduce(lambda x, y: x | y, c) for n in range(1, bits + 1) for c in combinations(one, n)]


def tally(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each pair of fingerprints, in how many of the eight positions their bytes are equal."""
    one, other = (np.ascontiguousarray(x, "<u8").view(np.uint8).reshape(-1, BYTES) for x in (left, right))
    return (one == other).sum(axis=1)


def retained(left: np.ndarray, right: np.ndarray, bits: int = MOST_BITS) -> np.ndarray:
    """Which candidates reach the guaranteed minimum of equal positions, and are verified then."""
    kept = tally(left, right) >= BYTES - bits
    kept[kept] = np.bitwise_count(left[kept] ^ right[kept]) <= bits
    return kept


def linked_groups(members: np.ndarray, whole: np.ndarray | None = None, bits: int = MOST_BITS) -> np.ndarray:
    """For each of some distinct 16-bit numbers the smallest place of its group, numbers being linked
    whose fingerprints (``whole``, or the numbers themselves) differ in at most so many bits."""
    n = len(members)
    whole = members.astype(np.uint64) if whole is None else whole
    place = np.full(1 << 16, -1, np.int32)
    place[members] = np.arange(n)
    near = [(at, np.flatnonzero(at >= 0)) for at in (place[members ^ m] for m in _nearby(bits))]
    pairs = [(own, at[own]) for at, own in near if len(own)]
    label = np.arange(n)
    if not pairs:
        return label
    left, right = (np.concatenate(x) for x in zip(*pairs, strict=True))
    kept = retained(whole[left], whole[right], bits)
    left, right = left[kept], right[kept]
    while True:
        before = label.copy()
        np.minimum.at(label, left, label[right])
        label = label[label]
        if (label == before).all():
            return label


def _stars(schema: pa.Schema):
    """Posting lists to links from each member to the first of its group."""

    def run(batches):
        for batch in batches:
            kinds, shared = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            left, right = [], []
            for k, rest in enumerate(batch.column(2)):
                members = rest.values.to_numpy()
                if len(members) == 2 and int(members[0] ^ members[1]).bit_count() > MOST_BITS:
                    continue
                high, low = FREE[kinds[k]]
                whole = (
                    shared[k].astype(np.uint64)
                    | (members.astype(np.uint64) >> np.uint64(8)) << np.uint64(8 * high)
                    | (members.astype(np.uint64) & np.uint64(0xFF)) << np.uint64(8 * low)
                )
                root = linked_groups(members, whole)
                own = np.flatnonzero(root != np.arange(len(members)))
                if len(own):
                    left.append(whole.view(np.int64)[own])
                    right.append(whole.view(np.int64)[root[own]])
            none = [np.zeros(0, np.int64)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(left or none)), pa.array(np.concatenate(right or none))], schema=schema
            )

    return run


def components(links: DataFrame) -> DataFrame:
    """node and root, the smallest node of its component, for nodes that have a link.

    Every round, each node sends its larger neighbours to its smallest, then its smaller ones; both
    keep components whole, and the links become stars around the smallest nodes. Rounds are written
    out, so a lost executor costs a re-read. Neighbours are reduced to their minimum map-side.
    """
    links = held(links.where("a != b").distinct(), "links")
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = held(
            small.union(least.select("a", F.col("m").alias("b")))
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .where("a != b").distinct(),
            "links",
        )
        # A star has no node on both sides.
        if after.join(after.select(F.col("a").alias("b")).distinct(), "b", "left_semi").isEmpty():
            doubled = after.groupBy("a").agg(F.count("*").alias("n")).where("n > 1")
            if doubled.isEmpty():
                return after.select(F.col("a").alias("node"), F.col("b").alias("root"))
        links = after


def fingerprint_groups(prints: DataFrame) -> DataFrame:
    """fingerprint and group (one of the group's fingerprints) for all distinct fingerprints."""
    distinct = held(prints.select("fingerprint").distinct(), "distinct-fingerprints")
    links = typed("a long, b long")
    # By number: packed by their few bytes, two tasks would make all the entries of the index.
    spread = distinct.repartition(max(1, -(-distinct.count() // TASK_FINGERPRINTS)), "fingerprint")
    stars = posting_lists(spread).mapInArrow(_stars(arrow_schema(links)), links)
    rooted = components(stars)
    return distinct.join(rooted, distinct["fingerprint"] == rooted["node"], "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("group")
    )


def near_duplicates(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    Texts link if their fingerprints differ in at most two bits; component_id is the smallest doc_id
    reachable over links. A text that is null or holds no word has fingerprint zero and links like
    any other. Rows without a doc_id take part but are never the smallest; a component of nothing
    else has a null component_id. Repeated ids and rows are rows like any others.
    """
    prints = held(fingerprints(docs, [F.col("doc_id")], words_per_shingle), "fingerprints")
    groups = fingerprint_groups(prints)
    first = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    grouped = held(groups.join(first, "fingerprint"), "groups")
    smallest = grouped.groupBy("group").agg(F.min("first").alias("component_id"))
    known = grouped.join(smallest, "group").select("fingerprint", "component_id")
    return prints.join(known, "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one_per_group(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of ``docs``, one of each group of near-duplicates: that with the smallest doc_id.

    Rows without an id stay only if no row of their group has one; ties of id go by a hash of the
    text, and of rows equal in both any one stays. All columns are returned as they are.
    """
    prints = held(fingerprints(docs, row_key(), words_per_shingle), "fingerprints")
    groups = fingerprint_groups(prints)
    rank = F.min(rank_struct("key_id", F.col("key_text"))).alias("first")
    firsts = prints.groupBy("fingerprint").agg(rank)
    chosen = (
        firsts.join(groups, "fingerprint").groupBy("group").agg(F.min("first").alias("first"))
        .select(F.col("first.id").alias("kept_id"), F.col("first.key_text").alias("kept_text"))
    )
    rows = whole_rows(docs)
    same = rows["key_id"].eqNullSafe(chosen["kept_id"]) & (rows["key_text"] == chosen["kept_text"])
    return rows.join(chosen, same, "left_semi").dropDuplicates(["key_id", "key_text"]).select("row.*")
