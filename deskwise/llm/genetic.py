"""Best-fit packing by a grouping genetic algorithm on islands.

Documents longer than a sequence are cut into full ones, which stand alone. The shorter pieces are dealt at
random to shards of bounded size. A shard is an instance of bin packing, and several islands, tasks of their
own, each breed solutions of it. A solution is a grouping of the shard's pieces. A child gets whole well-filled
bins of one parent; of the other's bins those that hold a piece of these are dissolved, the rest stay; the
pieces set free are placed by best fit, the longest first. After some generations the best solutions of
an island, its elite, move to the next island of the shard, and breeding goes on, until a lower bound
proves that no fewer bins will do, or the rounds are over.

What is then left in bins with room is dealt anew, bin by bin, to fewer shards, and bred on with the bins
as they are among the first solutions, so a level never needs more bins than it got. Levels go on while
they have more than one shard and get shorter.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskwise.llm.common import arrow_schema, held, ship, text_of, typed
from deskwise.llm.packing import PIECE, cut_documents

WINDOW = 2048
# Pieces of a shard on average: what a task holds at a time.
SHARD_PIECES = 2048
ISLANDS = 3
ROUNDS = 3
GENERATIONS = 12
POPULATION = 6
ELITE = 2
# Bins filled less than this are dealt anew.
WELL_FILLED = 0.985
# A level that leaves more than this share of its pieces in such bins is the last.
SHRINKING = 0.9

STATE = "shard long, island int, lengths binary, bound int, bins int, cost double, solutions array<binary>"
PLACED = "row long, shard long, bin int, offset int, fill int"
NO_BIN = -1


def lower_bound(lengths: np.ndarray, window: int) -> int:
    """Bins that any packing needs: for each k, those of the pieces too long to share a bin with one of k,
    and what of the pieces from k up to half a bin does not fit beside the longer ones."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=window + 1)
    up_to = np.cumsum(count)
    sums = np.cumsum(count * np.arange(window + 1))
    half = window // 2
    k = np.arange(half + 1)
    alone = up_to[window] - up_to[window - k]
    pairs = up_to[window - k] - up_to[half]
    room = pairs * window - (sums[window - k] - sums[half])
    small = sums[half] - np.concatenate([[0], sums])[k]
    return int(np.max(alone + pairs + np.maximum(0, -(-(small - room) // window))))


class Bins:
    """Bins by the room they have left, to which pieces are added by best fit."""

    def __init__(self, window: int, fills: list[int]):
        self.window = window
        self.fills = fills
        self.with_room: dict[int, list[int]] = {}
        self.rooms = 0
        for b, fill in enumerate(fills):
            self._put(b, window - fill)

    def _put(self, b: int, room: int) -> None:
        if room:
            self.with_room.setdefault(room, []).append(b)
            self.rooms |= 1 << room

    def add(self, length: int) -> int:
        """The bin that the piece leaves the least room in, a new one if it fits in none."""
        fitting = self.rooms >> length
        if not fitting:
            b = len(self.fills)
            self.fills.append(length)
            self._put(b, self.window - length)
            return b
        room = length + (fitting & -fitting).bit_length() - 1
        same = self.with_room[room]
        b = same.pop()
        if not same:
            self.rooms ^= 1 << room
        self.fills[b] += length
        self._put(b, room - length)
        return b


def best_fit(lengths: np.ndarray, window: int, order: np.ndarray, solution: np.ndarray | None = None) -> np.ndarray:
    """Pieces placed in that order beside those that ``solution`` has a bin for."""
    out = np.full(len(lengths), NO_BIN, np.int64) if solution is None else solution.copy()
    placed = out >= 0
    out[placed] = np.unique(out[placed], return_inverse=True)[1]
    bins = Bins(window, np.bincount(out[placed], weights=lengths[placed]).astype(np.int64).tolist())
    out[order] = [bins.add(n) for n in lengths[order].tolist()]
    return out


def fills_of(lengths: np.ndarray, solution: np.ndarray) -> np.ndarray:
    return np.bincount(solution, weights=lengths)


def cost(lengths: np.ndarray, solution: np.ndarray, window: int) -> float:
    """The bins, and less than one for how evenly they are filled: the more the room that is left lies in
    few bins, the better."""
    filled = fills_of(lengths, solution) / window
    return len(filled) + 1 - float(np.mean(filled**2)) / 2 if len(filled) else 0.0


def crossover(lengths: np.ndarray, window: int, one: np.ndarray, other: np.ndarray, rng) -> np.ndarray:
    """A child with some of the well-filled bins of one parent, and the bins of the other that share no
    piece with them."""
    fills = fills_of(lengths, one)
    good = fills >= max(WELL_FILLED * window, np.median(fills))
    taken = good & (rng.random(len(fills)) < rng.uniform(0.1, 0.6))
    injected = taken[one]
    spoilt = np.bincount(other[injected], minlength=other.max() + 1) > 0
    free = spoilt[other] & ~injected
    child = np.where(injected, one + other.max() + 1, other)
    child[free] = NO_BIN
    return best_fit(lengths, window, _descending(lengths, np.flatnonzero(free), rng), child)


def mutation(lengths: np.ndarray, window: int, solution: np.ndarray, rng) -> np.ndarray:
    """The least filled bins and some others are dissolved, their pieces placed anew."""
    fills = fills_of(lengths, solution)
    dissolved = rng.random(len(fills)) < 0.05
    dissolved[np.argsort(fills, kind="stable")[:3]] = True
    free = dissolved[solution]
    child = np.where(free, NO_BIN, solution)
    return best_fit(lengths, window, _descending(lengths, np.flatnonzero(free), rng), child)


def _descending(lengths: np.ndarray, pieces: np.ndarray, rng, noise: float = 0.05) -> np.ndarray:
    """Longest first, but for some disorder."""
    return pieces[np.argsort(-lengths[pieces] * (1 + noise * rng.random(len(pieces))), kind="stable")]


def breed(
    lengths: np.ndarray, window: int, solutions: list[np.ndarray], bound: int, rng,
    generations: int = GENERATIONS, population: int = POPULATION,
) -> list[np.ndarray]:
    """The best solutions after some generations, the best first; a proven best one ends them."""
    ranked = {}
    for s in solutions:
        ranked.setdefault(cost(lengths, s, window), s)

    def best() -> list[float]:
        return sorted(ranked)[:population]

    def add(s: np.ndarray) -> None:
        ranked.setdefault(cost(lengths, s, window), s)

    def proven() -> bool:
        return len(fills_of(lengths, ranked[min(ranked)])) <= bound

    if not ranked:
        add(best_fit(lengths, window, np.argsort(-lengths, kind="stable")))
    while len(ranked) < population // 2 and not proven():
        before = len(ranked)
        add(best_fit(lengths, window, _descending(lengths, np.arange(len(lengths)), rng, 0.3)))
        if len(ranked) == before:
            break
    for _ in range(generations):
        if proven():
            break
        costs = best()
        ranked = {c: ranked[c] for c in costs}
        for _ in range(population):
            one, other = (ranked[costs[int(len(costs) * rng.random() ** 2)]] for _ in range(2))
            child = crossover(lengths, window, one, other, rng)
            add(mutation(lengths, window, child, rng) if rng.random() < 0.5 else child)
    return [ranked[c] for c in best()]


def _evolve(window: int, schema: pa.Schema, seed: int):
    """One round on the islands of the batches: shard, island, lengths and solutions to breed from."""

    def run(batches):
        for batch in batches:
            rows = []
            for row in batch.select(["shard", "island", "lengths", "solutions"]).to_pylist():
                lengths = np.frombuffer(row["lengths"], "<i4").astype(np.int64)
                rng = np.random.default_rng([seed, row["shard"], row["island"]])
                bound = lower_bound(lengths, window)
                first = [np.frombuffer(s, "<i4").astype(np.int64) for s in row["solutions"]]
                found = breed(lengths, window, first, bound, rng)
                rows.append(
                    {**row, "bound": bound, "bins": len(fills_of(lengths, found[0])),
                     "cost": cost(lengths, found[0], window),
                     "solutions": [s.astype("<i4").tobytes() for s in found]}
                )
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def _islands(schema: pa.Schema):
    """Shards (pieces, sorted) to the state of their islands; the bins that pieces come in, if any, are the
    first solution."""

    def run(batches):
        for batch in batches:
            rows = []
            for shard, island, pieces in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lengths = np.array([-p["shorter"] for p in pieces], "<i4")
                came = [p["bin"] for p in pieces]
                first = []
                if came and came[0] is not None:
                    first = [np.unique(came, return_inverse=True)[1].astype("<i4").tobytes()]
                rows.append(
                    {"shard": shard, "island": island, "lengths": lengths.tobytes(), "bound": 0, "bins": 0,
                     "cost": 0.0, "solutions": first}
                )
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def _place(schema: pa.Schema):
    """Shards with their best solution to a row for each piece."""

    def run(batches):
        for batch in batches:
            out = [[] for _ in schema]
            for shard, pieces, best in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lengths = np.array([-p["shorter"] for p in pieces], np.int64)
                solution = np.frombuffer(best, "<i4").astype(np.int64)
                order = np.argsort(solution, kind="stable")
                ends = np.cumsum(lengths[order])
                fills = fills_of(lengths, solution).astype(np.int64)
                offset = ends - lengths[order] - (np.cumsum(fills) - fills)[solution[order]]
                out[0] += [pieces[k]["row"] for k in order.tolist()]
                out[1] += [shard] * len(order)
                out[2] += solution[order].tolist()
                out[3] += offset.tolist()
                out[4] += fills[solution[order]].tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema
            )

    return run


def _packed_level(pieces: DataFrame, window: int, islands: int, rounds: int) -> DataFrame:
    """Pieces (row, length, shard, bin) to their places. The bins of a shard's pieces are known, or none is."""
    state, placed = typed(STATE), typed(PLACED)
    each = F.struct((-F.col("length")).alias("shorter"), "row", "bin")
    # About SHARD_PIECES structs.
    shards = held(pieces.groupBy("shard").agg(F.sort_array(F.collect_list(each)).alias("pieces")), "shards")
    bred = (
        shards.select("shard", F.explode(F.array(*[F.lit(k) for k in range(islands)])).alias("island"), "pieces")
        .repartition("shard", "island")
        .mapInArrow(_islands(arrow_schema(state)), state)
        .mapInArrow(_evolve(window, arrow_schema(state), 0), state)
    )
    for number in range(1, rounds):
        bred = held(bred, "islands")
        elite = bred.select(
            "shard", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"),
            F.slice("solutions", 1, ELITE).alias("came"),
        )
        met = bred.join(elite, ["shard", "island"]).withColumn("solutions", F.concat("solutions", "came"))
        bred = met.select(*state.names).mapInArrow(_evolve(window, arrow_schema(state), number), state)
    best = bred.groupBy("shard").agg(
        F.min_by(F.col("solutions")[0], F.struct("cost", "island")).alias("best")
    )
    return shards.join(best, "shard").select("shard", "pieces", "best").mapInArrow(_place(arrow_schema(placed)), placed)


def best_fit_places(
    pieces: DataFrame, window: int = WINDOW, shard_pieces: int = SHARD_PIECES, islands: int = ISLANDS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """row, sequence and offset of pieces (row, length), all shorter than a window; row tells them apart."""
    todo = pieces.select("row", "length", F.lit(None).cast("long").alias("bin"))
    n, done, level = todo.count(), None, 0
    while True:
        count = max(1, ceil(n / shard_pieces))
        # Pieces that came in one bin stay together.
        key = F.col("row") if level == 0 else F.col("bin")
        dealt = todo.withColumn("shard", F.pmod(F.xxhash64(F.lit(level), key), F.lit(count)))
        placed = held(_packed_level(dealt, window, islands, rounds), "placed")
        number = (F.col("shard") * (1 << 17) + F.col("bin")) * 16 + (1 + level)
        full = F.col("fill") >= WELL_FILLED * window
        rest = placed.where(~full)
        left = rest.count()
        last = count == 1 or left > SHRINKING * n or level == 14
        final = (placed if last else placed.where(full)).select("row", number.alias("sequence"), "offset")
        done = final if done is None else done.unionByName(final)
        if last:
            return done
        lengths = pieces.select("row", "length")
        todo = held(rest.select("row", number.alias("bin")).join(lengths, "row").select("row", "length", "bin"), "rest")
        n, level = left, level + 1


def best_fit_pack(
    docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 0, window: int = WINDOW,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """Pieces of all documents in as few sequences of at most ``window`` tokens as the islands find.

    Returns doc_id, piece (from 0), start (the document's ids before it), length, ids (binary, unsigned
    32-bit little-endian, the end id behind the document's), sequence_id and offset (gapless from 0).

    Only documents longer than a window are cut, into full windows and a rest. A null text is empty; an
    empty document is its end id alone. Rows without a doc_id, and rows that repeat one, are documents of
    their own. Among equally good solutions that of the lowest island is taken, and breeding is seeded, so a
    run over the same stored pieces repeats. No documents: no rows. Columns other than doc_id and text are
    not read.
    """
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = typed(PIECE.format(id=kind))
    cut = docs.select("doc_id", text_of().alias("text")).mapInArrow(
        cut_documents(tokenizer, end_id, window, arrow_schema(schema)), schema
    )
    # The numbers are stored with the pieces, so that all reads agree on them.
    stored = held(cut.drop("doc_tokens").withColumn("row", F.monotonically_increasing_id()), "pieces")
    piece = F.expr(f"cast(start div {window} as int)").alias("piece")
    shown = ["doc_id", piece, "start", "length", "ids", "sequence_id", "offset"]
    full = stored.where(F.col("length") == window).select(
        "*", (F.col("row") * 16).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    short = stored.where(F.col("length") < window)
    places = best_fit_places(short.select("row", "length"), window, shard_pieces)
    # Places grow with the input: shuffled however few there are.
    placed = short.join(places.hint("merge"), "row").select(
        "*", F.col("sequence").alias("sequence_id"), F.col("offset").cast("long").alias("at")
    ).drop("offset").withColumnRenamed("at", "offset")
    return full.select(*shown).unionByName(placed.select(*shown))
