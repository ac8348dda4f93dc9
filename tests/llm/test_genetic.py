"""Best-fit packing: exact pieces, sound sequences, and how many of them against bounds and exhaustive search."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from deskwise.llm.genetic import (
    best_fit, best_fit_pack, best_fit_places, breed, cost, crossover, fills_of, lower_bound, mutation,
)

LIBRARY = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def fewest_bins(lengths, window):
    """By trying every grouping."""
    best = len(lengths)

    def go(k, bins):
        nonlocal best
        if len(bins) >= best and k < len(lengths):
            return
        if k == len(lengths):
            best = min(best, len(bins))
            return
        for b in range(len(bins)):
            if bins[b] + lengths[k] <= window:
                bins[b] += lengths[k]
                go(k + 1, bins)
                bins[b] -= lengths[k]
        bins.append(lengths[k])
        go(k + 1, bins)
        bins.pop()

    go(0, [])
    return best


SMALL = st.lists(st.integers(1, 19), min_size=1, max_size=8)


@settings(max_examples=150, deadline=None)
@given(SMALL)
def test_the_bound_is_one_and_breeding_meets_the_optimum(lengths):
    lengths = np.array(lengths)
    want = fewest_bins(lengths.tolist(), 20)
    bound = lower_bound(lengths, 20)
    assert bound <= want
    found = breed(lengths, 20, [], bound, np.random.default_rng(0))
    assert len(fills_of(lengths, found[0])) == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 99), min_size=2, max_size=60), st.integers(0, 1000))
def test_children_hold_every_piece_once_and_no_bin_is_too_full(lengths, seed):
    lengths, rng = np.array(lengths), np.random.default_rng(seed)
    one = best_fit(lengths, 100, rng.permutation(len(lengths)))
    other = best_fit(lengths, 100, rng.permutation(len(lengths)))
    for child in (crossover(lengths, 100, one, other, rng), mutation(lengths, 100, one, rng)):
        fills = fills_of(lengths, child)
        assert child.min() >= 0 and len(child) == len(lengths)
        assert fills.max() <= 100 and fills.min() > 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=60))
def test_best_fit_takes_the_tightest_bin(lengths):
    rooms, want = [], []
    for n in lengths:
        tight = min((r for r in rooms if r >= n), default=None)
        if tight is None:
            rooms.append(100 - n)
        else:
            rooms[rooms.index(tight)] -= n
        want.append(tight)
    lengths = np.array(lengths)
    fills = fills_of(lengths, best_fit(lengths, 100, np.arange(len(lengths))))
    assert sorted(fills) == sorted(100 - r for r in rooms)


def test_injected_bins_stay_whole():
    rng = np.random.default_rng(1)
    lengths = np.array([50] * 40)
    one, other = np.arange(40) // 2, np.arange(40) % 20
    for _ in range(10):
        child = crossover(lengths, 100, one, other, rng)
        groups = {tuple(np.flatnonzero(child == b)) for b in range(child.max() + 1)}
        parents = {tuple(np.flatnonzero(p == b)) for p in (one, other) for b in range(20)}
        assert len(groups & parents) >= 1 and len(fills_of(lengths, child)) >= 20


def test_breeding_beats_best_fit():
    lengths = np.random.default_rng(3).integers(600, 760, 1024)
    first = best_fit(lengths, 2048, np.argsort(-lengths, kind="stable"))
    found = breed(lengths, 2048, [first], lower_bound(lengths, 2048), np.random.default_rng(0))
    assert cost(lengths, found[0], 2048) < cost(lengths, first, 2048) - 5


def sequences(rows):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    return {k: sorted(v, key=lambda r: r.offset) for k, v in by.items()}


def check_sequences(rows, window=2048):
    for inside in sequences(rows).values():
        end = 0
        for r in inside:
            assert r.offset == end
            end += r.length
        assert end <= window


@pytest.mark.parametrize("shard_pieces, over", [(20, 9), (100, 3), (5000, 1)])
def test_places_of_many_shards(spark, shard_pieces, over):
    lengths = np.random.default_rng(7).integers(1, 1200, 1000).tolist()
    pieces = spark.createDataFrame(list(enumerate(lengths)), "row long, length long")
    places = best_fit_places(pieces, 2048, shard_pieces)
    rows = places.withColumnRenamed("sequence", "sequence_id").join(pieces, "row").collect()
    assert sorted(r.row for r in rows) == list(range(1000))
    check_sequences(rows)
    bound = lower_bound(np.array(lengths), 2048)
    assert len(sequences(rows)) <= bound + over


def test_levels_never_need_more_bins(spark):
    """Pieces of which no two fit together: dealing anew cannot help, and ends."""
    pieces = spark.createDataFrame([(k, 1100) for k in range(200)], "row long, length long")
    assert best_fit_places(pieces, 2048, 50).select("sequence").distinct().count() == 200


def library_pieces(rows):
    want = []
    for name, text in rows:
        ids = np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for k in range(0, len(ids), 2048):
            part = ids[k : k + 2048]
            want.append((name, k // 2048, k, len(part), zlib.crc32(part.tobytes())))
    return sorted(want, key=repr)


def packed_pieces(docs):
    rows = best_fit_pack(docs).withColumn("crc", F.crc32("ids")).collect()
    check_sequences(rows)
    return sorted(((r.doc_id, r.piece, r.start, r.length, r.crc) for r in rows), key=repr), rows


def test_nulls_empty_and_long_texts_ties_and_repeated_rows(spark, docs_of):
    rows = [
        (1, None), (2, ""), (None, "no id"), (None, "no id"), (3, "same"), (3, "same"), (4, "same"),
        (5, "word " * 2047), (6, "word " * 2048), (7, "word " * 9000), (8, "a\n\t b"),
    ]
    got, packed = packed_pieces(docs_of(rows, "row length bin shard sequence sequence_id offset piece a.b ROW"))
    assert got == library_pieces(rows)
    assert len({r.sequence_id for r in packed}) == 1 + 1 + 4 + 1
    assert packed_pieces(docs_of(rows).where("false"))[0] == []


def test_the_given_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got, packed = packed_pieces(docs)
    assert got == library_pieces(rows)
    lengths = np.array([r.length for r in packed])
    short = lengths[lengths < 2048]
    fewest = int((lengths == 2048).sum()) + lower_bound(short, 2048)
    assert len({r.sequence_id for r in packed}) == fewest

