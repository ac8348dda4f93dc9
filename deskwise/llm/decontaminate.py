"""Benchmark decontamination: test items in a BM25 index, every training passage a query.

Items are sorted by the score they give themselves and cut into blocks; each term of the index keeps
its postings, its largest weight in every block, and its largest anywhere. A passage is a window of
words, long enough that any item lies whole in one of them. WAND skips a passage whose terms' largest
weights cannot reach the lowest threshold of all items; block-max WAND skips the blocks whose own
maxima cannot reach their lowest threshold; what is left is scored exactly. All items that score at
least THRESHOLD of their own score are candidates, and each is verified: SIMILARITY of the whole item's
five-word shingles must stand in the passage, or of those of question and answer each (of the words of
a short answer).

The index is built in parts of bounded size, each by a task, and stored in the shared folder. Documents are
scanned once per part, and a worker holds one part at a time, so its memory grows neither with the
documents nor with the items. Document frequencies and the mean length are counted over all items.
"""

from __future__ import annotations

import pickle
import re
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskwise.llm.common import arrow_schema, held, row_key, ship, text_of, typed, whole_rows
from deskwise.llm.files import publishing, reading
from deskwise.session import scratch_dir

K1, B = 1.2, 0.75
THRESHOLD = 0.5
SIMILARITY = 0.8
SHINGLE_WORDS = 5
# Answers of fewer words are compared word by word: a shingle would be most of them.
SHORT_ANSWER = 10
# Items whose postings are searched or skipped together.
BLOCK_ITEMS = 16
# Words of the items that one part of the index holds, on average.
INDEX_WORDS = 1 << 20
# Words between the beginnings of two passages.
STRIDE = 64
# Windows of a document scored together.
BATCH_WINDOWS = 256

# Letters and digits of any script make words; ASCII punctuation and control characters part them.
APART = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n")


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().translate(APART).split()


def shingles(words: list[bytes], n: int = SHINGLE_WORDS) -> set[tuple[bytes, ...]]:
    """All runs of n words; of fewer words, the run of all."""
    if not words:
        return set()
    return {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))}


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentence that holds a word is the answer; a single sentence is all question."""
    parts = [p for p in SENTENCE.split(text) if words_of(p)]
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (text, "")


class Index:
    """BM25 postings of some items, with the maxima that let passages skip them."""

    def __init__(self, items: list[tuple], n: int, mean_length: float, df: dict[bytes, int]):
        """items: (id, question, answer) as lists of words; n, mean_length and df are of all items."""
        self.number = {t: k for k, t in enumerate(sorted({w for _, q, a in items for w in q + a}))}
        idf = {t: np.log1p((n - df[t] + 0.5) / (df[t] + 0.5)) for t in self.number}
        postings, own = [], []
        for k, (_, question, answer) in enumerate(items):
            terms, tf = np.unique([self.number[w] for w in question + answer], return_counts=True)
            norm = K1 * (1 - B + B * (len(question) + len(answer)) / mean_length)
            names = [idf[w] for w in sorted({*question, *answer})]
            weight = np.array(names) * tf * (K1 + 1) / (tf + norm)
            postings.append((terms, np.full(len(terms), k), weight))
            own.append(weight.sum())
        # Items of like scores share a block, so that a block's lowest threshold is close to all of its.
        order = np.argsort(own, kind="stable")
        rank = np.empty(len(items), np.int64)
        rank[order] = np.arange(len(items))
        self.items = [items[k] for k in order]
        self.threshold = THRESHOLD * np.array(own)[order] - 1e-9
        term, item, weight = (np.concatenate(x) for x in zip(*postings, strict=True))
        item = rank[item]
        by = np.lexsort((item, term))
        term, self.item, self.weight = term[by], item[by], weight[by]
        self.first = np.searchsorted(term, np.arange(len(self.number) + 1))
        blocks = -(-len(items) // BLOCK_ITEMS)
        self.block_threshold = np.array([self.threshold[b * BLOCK_ITEMS] for b in range(blocks)])
        # Maxima only of the blocks that hold a posting of the term.
        block = self.item // BLOCK_ITEMS
        heads = np.flatnonzero((np.diff(term, prepend=-1) != 0) | (np.diff(block, prepend=-1) != 0))
        self.block, self.block_most = block[heads], np.maximum.reduceat(self.weight, heads)
        self.block_first = np.searchsorted(term[heads], np.arange(len(self.number) + 1))
        self.most = np.maximum.reduceat(self.block_most, self.block_first[:-1])
        self.longest = max(len(q) + len(a) for _, q, a in items)
        self.checks = [
            (shingles(q), shingles(a, 1 if len(a) < SHORT_ANSWER else SHINGLE_WORDS), shingles(q + a))
            for _, q, a in self.items
        ]

    def passages(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The sets of terms of a document's windows, as rows (window, term), and where each begins."""
        length = self.longest + STRIDE
        windows = -(-max(len(codes) - self.longest, 1) // STRIDE)
        known = np.flatnonzero(codes >= 0)
        # Each known word belongs to the windows that begin at most a window before it.
        reach = -(-length // STRIDE)
        window = (known // STRIDE)[:, None] - np.arange(reach)
        inside = (window >= 0) & (window < windows) & (known[:, None] < window * STRIDE + length)
        terms = np.broadcast_to(codes[known][:, None], window.shape)[inside]
        pairs = np.unique(window[inside] * len(self.number) + terms)
        window, terms = np.divmod(pairs, len(self.number))
        return window, terms, np.flatnonzero(np.diff(window, prepend=-1))

    def search(self, window: np.ndarray, terms: np.ndarray, heads: np.ndarray):
        """(window, item, score) of all items that reach their threshold in a window."""
        # WAND: can the terms of the window reach any item's threshold at all?
        reach = np.add.reduceat(self.most[terms], heads) >= self.block_threshold.min() - 1e-3
        sizes = np.diff(np.append(heads, len(terms)))
        stay = np.repeat(reach, sizes)
        window, terms, sizes = window[stay], terms[stay], sizes[reach]
        if not len(terms):
            return window, terms, np.zeros(0)
        # Block-max WAND: and the threshold of which blocks of items?
        heads = np.cumsum(sizes) - sizes
        row, blocks = np.repeat(np.arange(len(sizes)), sizes), len(self.block_threshold)
        n = self.block_first[terms + 1] - self.block_first[terms]
        slots = np.repeat(self.block_first[terms] - np.cumsum(n) + n, n) + np.arange(n.sum())
        key = np.repeat(row, n) * blocks + self.block[slots]
        most = np.bincount(key, weights=self.block_most[slots], minlength=len(sizes) * blocks)
        blocks = most.reshape(len(sizes), blocks) >= self.block_threshold - 1e-3
        # The postings of what is left: each term's, in the blocks that are open to its window.
        first, n = self.first[terms], self.first[terms + 1] - self.first[terms]
        slots = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
        row, item = np.repeat(row, n), self.item[slots]
        is_open = blocks[row, item // BLOCK_ITEMS]
        key = row[is_open] * len(self.items) + item[is_open]
        scores = np.bincount(key, weights=self.weight[slots[is_open]])
        key = np.flatnonzero(scores)
        row, item = np.divmod(key, len(self.items))
        enough = scores[key] >= self.threshold[item]
        return window[heads[row[enough]]], item[enough], scores[key[enough]]

    def matches(self, words: list[bytes]) -> dict[int, tuple]:
        """Verified items of a document: item to (score, question overlap, answer overlap, begin)."""
        codes = np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))
        found: dict[int, tuple] = {}
        if (codes < 0).all():
            return found
        window, terms, heads = self.passages(codes)
        # Windows are scored together, but not so many that a long document needs much memory.
        cuts = [0, *heads[BATCH_WINDOWS::BATCH_WINDOWS].tolist(), len(terms)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            own = heads[(heads >= a) & (heads < b)] - a
            for at, item, score in zip(*map(np.ndarray.tolist, self.search(window[a:b], terms[a:b], own)), strict=True):
                passage = words[at * STRIDE : at * STRIDE + self.longest + STRIDE]
                question, answer, whole = self.checks[item]
                in_question, in_answer = _share(question, passage), _share(answer, passage)
                if min(in_question, in_answer) < SIMILARITY and _share(whole, passage) < SIMILARITY:
                    continue
                if item not in found or found[item][0] < score:
                    found[item] = (score, in_question, in_answer, at * STRIDE)
        return found


def _share(wanted: set, passage: list[bytes]) -> float:
    """The part of some shingles that stands in the passage."""
    if not wanted:
        return 1.0
    size = len(next(iter(wanted)))  # fewer than SHINGLE_WORDS if the text is shorter
    return len(wanted & shingles(passage, size)) / len(wanted)


MATCH = "item_id {item}, score double, question_overlap double, answer_overlap double, word long"


@lru_cache(maxsize=1)
def load_index(folder: str, name: str) -> Index:
    """A stored part; a worker keeps the one it scans for."""
    with reading(folder, name) as source:
        return pickle.loads(source.read())


def _scan(folder: str, name: str, schema: pa.Schema):
    """Documents (keys, text) to their matches."""

    def run(batches):
        index = load_index(folder, name)
        for batch in batches:
            rows, found = [], []
            for k, text in enumerate(batch.column(len(batch.schema) - 1).to_pylist()):
                for item, match in sorted(index.matches(words_of(text)).items()):
                    rows.append(k)
                    found.append((index.items[item][0], *match))
            at = pa.array(rows, pa.int64())
            columns = zip(*found, strict=True) if found else [()] * 5
            kinds = [schema.field(k).type for k in range(len(schema) - 5, len(schema))]
            yield pa.RecordBatch.from_arrays(
                [*(c.take(at) for c in batch.columns[:-1]),
                 *(pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True))],
                schema=schema,
            )

    return run


SPLIT = "item_id {item}, question array<binary>, answer array<binary>"


def _split(schema: pa.Schema):
    """Items to the words of their questions and answers."""

    def run(batches):
        for batch in batches:
            texts = [c.to_pylist() for c in batch.columns[1:]]
            parts = zip(*texts, strict=True) if len(texts) == 2 else map(question_and_answer, texts[0])
            words = [(words_of(q), words_of(a)) for q, a in parts]
            kind = pa.list_(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([q for q, _ in words], kind), pa.array([a for _, a in words], kind)],
                schema=schema,
            )

    return run


def _build(folder: str, n: int, mean_length: float):
    """The items of a part, with the document frequencies of their words, to its stored index."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["item_id", "question", "answer", "frequencies"]).to_pylist()
        df = {f["term"]: f["df"] for r in rows for f in r["frequencies"]}
        # In an order that does not depend on how the rows arrived.
        items = sorted(((r["item_id"], r["question"], r["answer"]) for r in rows), key=repr)
        name = f"part-{table.column('part')[0].as_py():06d}.index"
        with publishing(folder, name) as out:
            out.write(pickle.dumps(Index(items, n, mean_length, df), protocol=5))
        return pa.table({"name": [name]})

    return run


def store_indexes(items: DataFrame, index_words: int = INDEX_WORDS) -> tuple[str, list[str]]:
    """Index all items, in parts of about ``index_words`` words. Returns their folder and names.

    ``items`` has item_id and question and answer, both, or a text. Items without a word are left out.
    Rows are dealt to parts one by one, so that repeated ones do not gather in one.
    """
    spark = items.sparkSession
    ship(spark)
    folder = scratch_dir(spark, "benchmark-index")
    both = {"question", "answer"} <= set(items.columns)
    texts = ["question", "answer"] if both else ["text"]
    schema = typed(SPLIT.format(item=items.schema["item_id"].dataType.simpleString()))
    split = items.select("item_id", *[text_of(c).alias(c) for c in texts]).mapInArrow(
        _split(arrow_schema(schema)), schema
    )
    rows = held(
        split.where(F.size("question") + F.size("answer") > 0).withColumn("row", F.monotonically_increasing_id()),
        "benchmark-items",
    ).withColumn("words", F.concat("question", "answer"))
    total = rows.agg(F.count("*").alias("items"), F.sum(F.size("words")).alias("words")).first()
    if not total.items:
        return folder, []
    terms = rows.select("row", F.explode(F.array_distinct("words")).alias("term"))
    frequencies = terms.groupBy("term").agg(F.count("*").alias("df"))
    known = terms.join(frequencies, "term").groupBy("row").agg(
        F.collect_list(F.struct("term", "df")).alias("frequencies")  # as many as the item has words
    )
    parts = max(1, -(-total.words // index_words))
    dealt = rows.join(known, "row").withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
    stored = dealt.select("part", "item_id", "question", "answer", "frequencies").groupBy("part").applyInArrow(
        _build(folder, total.items, total.words / total.items), "name string"
    )
    return folder, sorted(r["name"] for r in stored.collect())


def contaminated(docs: DataFrame, items: DataFrame, keys: list | None = None) -> DataFrame:
    """Test items found in documents: the keys (doc_id), item_id, score, question_overlap,
    answer_overlap and word, the number of the document's word the best passage begins at. An overlap of
    one part is under SIMILARITY where the item as a whole reaches it.

    One row per row of ``docs`` and item. Documents and items whose text is null or holds no word
    match nothing, no items or no documents give no rows. Items that share an id or a text are items
    of their own. Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(*(keys or ["doc_id"]), text_of().alias("scanned"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    item = items.schema["item_id"].dataType.simpleString()
    schema = typed(", ".join([*fields, MATCH.format(item=item)]))
    out = spark.createDataFrame([], schema)
    folder, names = store_indexes(items)
    for name in names:
        out = out.unionByName(rows.mapInArrow(_scan(folder, name, arrow_schema(schema)), schema))
    return out


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no test item, all columns as they are.

    A null or empty text holds none and stays, as do rows without an id. Rows equal in doc_id and text fare
    alike, and all of them stay or go; no items or no documents change nothing.
    """
    hits = contaminated(docs, items, row_key()).select(
        F.col("key_id").alias("hit_id"), F.col("key_text").alias("hit_text")
    ).distinct()
    rows = whole_rows(docs)
    same = rows["key_id"].eqNullSafe(hits["hit_id"]) & (rows["key_text"] == hits["hit_text"])
    return rows.join(hits, same, "left_anti").select("row.*")
