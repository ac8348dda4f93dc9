"""Packing documents into fixed windows with lexical neighbours.

A document is cut into pieces of at most one window. Full windows are sequences of their own. The
rest are dealt over shards of bounded size by lexical affinity: terms have one order for all pieces, in
which a rare one tends to come first, and a piece goes to the shard of its first term, so that pieces
meet the more often the more of their rare terms they share. A term with more than a shard's tokens has
several shards, over which its pieces are dealt at random. No other shard is asked. Each shard holds a BM25 inverted index over
token ids of its pieces, with document frequencies and the mean length counted over all pieces of the
corpus. A seed piece opens a sequence, the index ranks the unused pieces for it, the best that still
fit are added whole, and the best one that does not is cut to fill what is left of the window. What
was cut off stays unused and is placed later, so only the last sequence of a shard is ever short.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskwise.llm.common import arrow_schema, by_size, held, ship, text_of, typed
from deskwise.llm.tokens import encoder

WINDOW = 2048
# Tokens of a shard's pieces, on average: a task holds one shard, and ranking for a seed costs in
# proportion to it.
SHARD_TOKENS = 1 << 19
K1, B = 1.2, 0.75
# The index of a shard is cut down when no more than this share of its pieces is still unused.
STILL_UNUSED = 0.8

PIECE = "doc_id {id}, start long, length long, doc_tokens long, ids binary"
PACKED = "doc_id {id}, start long, length long, doc_tokens long, ids binary, sequence_id long, offset long"
# Rows of the statistics that are not terms.
N_PIECES, N_TOKENS, N_REST = -1, -2, -3


# Bytes of text that are cut at a time.
CUT_BYTES = 4 << 20


def cut_documents(tokenizer: str, end_id: int, window: int, schema: pa.Schema):
    """Documents to pieces of at most a window, each with its ids."""

    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        for batch in (part for whole in batches for part in by_size(whole, 1, CUT_BYTES)):
            texts = batch.column(1).to_pylist()
            whole = [ids + end for ids in encoder(tokenizer).encode(texts)]
            rows, starts, lengths, totals, pieces = [], [], [], [], []
            for k, ids in enumerate(whole):
                n = len(ids) // 4
                for start in range(0, n, window):
                    rows.append(k)
                    starts.append(start)
                    lengths.append(min(window, n - start))
                    totals.append(n)
                    pieces.append(ids[4 * start : 4 * (start + window)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(starts), pa.array(lengths),
                 pa.array(totals), pa.array(pieces, pa.binary())],
                schema=schema,
            ) if rows else pa.RecordBatch.from_pylist([], schema=schema)
        # The worker stays for other tasks; what Arrow has kept for reuse goes back.
        pa.default_memory_pool().release_unused()

    return run


def _frequencies(window: int):
    """Per task: for each term the pieces that hold it, and the totals."""

    def run(batches):
        # The counts of up to 255 pieces are kept in bytes, which are quick to add.
        counts, few, seen = np.zeros(0, np.int64), np.zeros(0, np.uint8), np.zeros(0, np.uint8)
        totals = {N_PIECES: 0, N_TOKENS: 0, N_REST: 0}
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                ids = np.frombuffer(raw, "<u4").astype(np.intp)
                if (top := int(ids.max())) >= len(counts):
                    counts, few, seen = (np.pad(a, (0, top + 1 - len(a))) for a in (counts, few, seen))
                # Each term once.
                seen[ids] = 1
                few += seen
                seen[ids] = 0
                totals[N_PIECES] += 1
                totals[N_TOKENS] += len(ids)
                totals[N_REST] += len(ids) if len(ids) < window else 0
                if totals[N_PIECES] % 255 == 0:
                    counts += few
                    few[:] = 0
        counts += few
        terms = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*totals, *terms.tolist()], pa.int64()),
             pa.array([*totals.values(), *counts[terms].tolist()], pa.int64())],
            names=["term", "n"],
        )

    return run


class InvertedIndex:
    """Postings of one shard: for each term the pieces that hold it and what it adds to their score."""

    def __init__(self, pieces: list[np.ndarray], idf: np.ndarray, mean_length: float):
        each = [np.unique(ids, return_counts=True) for ids in pieces]
        self.terms_of = [terms for terms, _ in each]
        self.size = len(pieces)
        piece = np.repeat(np.arange(self.size), [len(t) for t in self.terms_of])
        term = np.concatenate(self.terms_of)
        tf = np.concatenate([n for _, n in each]).astype(np.float64)
        norm = K1 * (1 - B + B * np.array([len(p) for p in pieces]) / mean_length)
        weight = idf[term] * tf * (K1 + 1) / (tf + norm[piece])
        order = np.argsort(term, kind="stable")
        self.term, self.first = np.unique(term[order], return_index=True)
        self.last = np.append(self.first[1:], len(term))
        self.piece, self.weight = piece[order], weight[order]

    def keep(self, wanted: np.ndarray) -> None:
        """Drop the postings of the other pieces; their scores are nothing from then on."""
        kept = wanted[self.piece]
        before = np.append(0, np.cumsum(kept))
        self.first, self.last = before[self.first], before[self.last]
        self.piece, self.weight = self.piece[kept], self.weight[kept]

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """BM25 of every piece of the shard for a set of terms that the shard holds."""
        at = np.searchsorted(self.term, terms)
        first, n = self.first[at], (self.last - self.first)[at]
        slots = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return np.bincount(self.piece[slots], weights=self.weight[slots], minlength=self.size)


def fill_windows(pieces: list[np.ndarray], index: InvertedIndex, window: int):
    """Yield (piece, from, to, sequence, offset); pieces open sequences in their order."""
    begin = np.zeros(len(pieces), np.int64)
    left = np.array([len(p) for p in pieces])
    sequence, indexed = 0, len(pieces)
    for seed in range(len(pieces)):
        if not left[seed]:
            continue
        # Pieces that are used up are not ranked: they leave the index when enough of them can.
        if (unused := np.count_nonzero(left)) <= STILL_UNUSED * indexed:
            index.keep(left > 0)
            indexed = unused
        yield seed, int(begin[seed]), len(pieces[seed]), sequence, 0
        room, offset = window - int(left[seed]), int(left[seed])
        left[seed] = 0
        scores = None
        while room and left.any():
            if scores is None:
                scores = index.scores(index.terms_of[seed])
            fits = (left > 0) & (left <= room)
            among = fits if fits.any() else left > 0
            best = int(np.argmax(np.where(among, scores, -1.0)))
            take = min(room, int(left[best]))
            at = int(begin[best])
            yield best, at, at + take, sequence, offset
            begin[best] += take
            left[best] -= take
            room, offset = room - take, offset + take
        sequence += 1


def term_order(df: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """A number for each term; the smallest of a piece's names it, the term with the chance idf^2 has
    among all of its terms (weighted min-hash). Terms of one piece only bring none together."""
    chance = -np.log1p(-np.random.default_rng(0).random(len(df)))
    return np.where(df > 1, chance / np.maximum(idf, 1e-9) ** 2, np.inf)


def first_terms(order: np.ndarray, ids: pa.Array) -> np.ndarray:
    return np.array([k[np.argmin(order[k])] for k in (np.frombuffer(raw, "<u4") for raw in ids.to_pylist())], np.int64)


def _first_tokens(order):
    """Per batch: the tokens of the pieces of each first term."""

    def run(batches):
        for batch in batches:
            terms, at = np.unique(first_terms(order.value, batch.column(0)), return_inverse=True)
            n = np.bincount(at, weights=batch.column(1).to_numpy(), minlength=len(terms)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(n)], names=["term", "n"])

    return run


def deal(tokens: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Where on the line of shards each term's pieces begin, and over how much of it they are spread: a
    term of up to a shard's tokens lies at one point, so that its pieces stay together."""
    size = tokens.sum() / shards
    begin = np.cumsum(tokens) - tokens
    small = tokens <= size
    return np.where(small, begin + tokens / 2, begin) / size, np.where(small, 0, tokens) / size


def _dealt(order, places, shards: int, schema: pa.Schema):
    """Pieces with a number from 0 to 1 last to pieces with their shard last."""

    def run(batches):
        for batch in batches:
            begin, spread = places.value
            terms = first_terms(order.value, batch.column("ids"))
            at = begin[terms] + spread[terms] * batch.columns[-1].to_numpy()
            shard = pa.array(np.minimum(at.astype(np.int64), shards - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], shard], schema=schema)

    return run


def _pack_shard(idf, window: int, schema: pa.Schema):
    """Fills the windows of one shard, whose rows arrive in any order."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        weights, mean_length = idf.value
        pieces = [np.frombuffer(raw, "<u4") for raw in table.column("ids").to_pylist()]
        index = InvertedIndex(pieces, weights, mean_length)
        placed = list(fill_windows(pieces, index, window))
        shard = table.column("shard")[0].as_py()
        row, first, last, sequence, offset = (np.array(x, np.int64) for x in zip(*placed, strict=True))
        start = table.column("start").to_numpy()[row] + first
        return pa.Table.from_arrays(
            [table.column("doc_id").take(row), pa.array(start), pa.array(last - first),
             table.column("doc_tokens").take(row),
             pa.array([pieces[k][a:b].tobytes() for k, a, b, _, _ in placed], pa.binary()),
             # odd numbers; the windows that were full from the start have the even ones
             pa.array((shard * (1 << 31) + sequence) * 2 + 1), pa.array(offset)],
            schema=schema,
        )

    return run


def pack(
    docs: DataFrame,
    tokenizer: str = "byte_bpe_50k.json",
    end_id: int = 1,
    window: int = WINDOW,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most ``window`` tokens.

    Returns doc_id, start (the document's ids before the piece), length, doc_tokens (with the end
    id), ids (binary, unsigned 32-bit little-endian), sequence_id and offset (gapless from 0).

    A null text is empty; an empty document is its end id alone. Rows without a doc_id, and rows that
    repeat one, are documents of their own. Ties of score go to the piece that comes first in the
    stored order. No documents: no rows. Columns other than doc_id and text are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    pieces = typed(PIECE.format(id=kind))
    cut = docs.select("doc_id", text_of().alias("text")).mapInArrow(
        cut_documents(tokenizer, end_id, window, arrow_schema(pieces)), pieces
    )
    stored = held(cut, "pieces")

    counted = stored.select("ids").mapInArrow(_frequencies(window), "term long, n long")
    # A row per entry of the vocabulary at most.
    counts = {r.term: r.n for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    n, tokens, rest = (counts.pop(k, 0) for k in (N_PIECES, N_TOKENS, N_REST))
    df = np.zeros(max(counts, default=0) + 1)
    df[list(counts)] = list(counts.values())
    idf = spark.sparkContext.broadcast((np.log1p((n - df + 0.5) / (df + 0.5)), tokens / max(n, 1)))

    packed = typed(PACKED.format(id=kind))
    numbered = stored.withColumn("row", F.monotonically_increasing_id())
    full = numbered.where(F.col("length") == window).select(
        "doc_id", "start", "length", "doc_tokens", "ids",
        (F.col("row") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    shards = max(1, -(-rest // shard_tokens))
    rows = numbered.where(F.col("length") < window)
    if shards == 1:
        rows = rows.withColumn("shard", F.lit(0).cast("long"))
    else:
        order = spark.sparkContext.broadcast(term_order(df, idf.value[0]))
        tokens = rows.select("ids", "length").mapInArrow(_first_tokens(order), "term long, n long")
        sums = np.zeros(len(df))
        for r in tokens.groupBy("term").agg(F.sum("n").alias("n")).collect():  # as bounded as the counts
            sums[r.term] = r.n
        places = spark.sparkContext.broadcast(deal(sums, shards))
        dealt = typed(f"{PIECE.format(id=kind)}, row long, shard long")
        chance = F.pmod(F.xxhash64("row"), F.lit(1 << 30)) / F.lit(float(1 << 30))
        rows = rows.withColumn("chance", chance).mapInArrow(_dealt(order, places, shards, arrow_schema(dealt)), dealt)
    short = rows.groupBy("shard").applyInArrow(_pack_shard(idf, window, arrow_schema(packed)), packed)
    return full.unionByName(short)

