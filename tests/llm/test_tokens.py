import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from deskwise.llm import rans, tokens
from deskwise.llm.packing import N_PIECES, N_REST, N_TOKENS, InvertedIndex, _frequencies, fill_windows, pack
from deskwise.llm.token_counts import corpus_token_counts, count_tokens
from deskwise.llm.token_files import File, encode_corpus, write_file
from deskwise.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = Encoder(PATH)
ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "\n", "a\n\nb c", "don't we'll  x", "é ü ß", "a b c",
    "x <|endoftext|> y", "x<|endoftext|>y z", "1 2  3\t4", "日本 語 テスト", "a\x1c b", "  a b", "🙂 🙂🙂 a",
]


def library_ids(text, end=None):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return ids if end is None else [*ids, end]


def as_ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


@pytest.mark.parametrize("text", ODD)
def test_ids_are_the_librarys(text):
    assert as_ids(ENCODER.encode([text])[0]) == library_ids(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab'é \n\t.1 \x1c🙂ſ"), max_size=30), max_size=5))
def test_ids_of_any_text(texts):
    assert [as_ids(x) for x in ENCODER.encode(texts)] == [library_ids(t) for t in texts]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 60000), max_size=400), st.integers(0, 400), st.integers(0, 400))
def test_token_file_round_trip(ids, a, b):
    ids = np.array(ids, "<u4")
    out = pa.BufferOutputStream()
    write_file(out, ids, pa.array([1, None]), np.array([len(ids), 0]))
    file = File(pa.BufferReader(out.getvalue()))
    assert file.ids(0, len(ids)).tolist() == ids.tolist()
    begin, end = sorted((min(a, len(ids)), min(b, len(ids))))
    assert file.ids(begin, end).tolist() == ids[begin:end].tolist()
    assert file.documents.column("doc_id").to_pylist() == [1, None]


def test_token_file_of_many_blocks_is_small_and_checked():
    ids = (np.random.default_rng(1).zipf(1.4, 300_000) % 50_000).astype("<u4")
    out = pa.BufferOutputStream()
    write_file(out, ids, pa.array([1]), np.array([len(ids)]))
    raw = bytearray(out.getvalue().to_pybytes())
    file = File(pa.BufferReader(bytes(raw)))
    assert (file.ids(70_000, 200_001) == ids[70_000:200_001]).all()
    table = rans.Table.count(ids)
    bits = -np.log2(table.frequencies / (1 << rans.SCALE))[np.searchsorted(table.symbols, ids)].sum()
    head = 8 * len(table.symbols)
    assert len(raw) - head < 1.03 * bits / 8 + 2000
    raw[int(file.checkpoints[1]["offset"]) + 600] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        File(pa.BufferReader(bytes(raw))).ids(0, len(ids))


def test_table_of_one_and_of_many_symbols():
    assert rans.Table.count(np.array([7, 7])).frequencies.tolist() == [1 << rans.SCALE]
    many = rans.Table.count(np.concatenate([np.arange(60_000), np.zeros(10**6, np.int64)]))
    assert many.frequencies.sum() == 1 << rans.SCALE and many.frequencies.min() == 1


TEXTS = [(3, "a b c"), (1, None), (2, ""), (None, "no id " * 40), (5, "long text " * 3000), (5, "again"), (5, "again"), (4, "x  \n y ")]


def test_token_files_in_id_order(docs_of):
    rows = encode_corpus(docs_of(TEXTS, "ids file start")).collect()
    assert len(rows) == len(TEXTS)
    by_start = sorted(rows, key=lambda r: r.start)
    at = 0
    for r in by_start:
        assert r.start == at and r.n_tokens == len(r.ids) // 4 and as_ids(r.ids)[-1] == 2
        at += r.n_tokens
    assert [r.doc_id for r in by_start] == [None, 1, 2, 3, 4, 5, 5, 5]
    want = sorted((repr(i), zlib.crc32(np.array(library_ids(t, 2), "<u4").tobytes())) for i, t in TEXTS)
    assert sorted((repr(r.doc_id), zlib.crc32(r.ids)) for r in rows) == want
    assert encode_corpus(docs_of([])).count() == 0


def test_pack_places_every_id_once(docs_of):
    rows = pack(docs_of(TEXTS, "ids row shard"), window=256, shard_tokens=512).collect()
    pieces = {}
    for r in rows:
        assert r.length == len(r.ids) // 4 > 0
        pieces.setdefault(r.sequence_id, []).append(r)
    short = 0
    for own in pieces.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 256
        short += at < 256
    assert short <= -(-sum(r.length for r in rows) // 512) + 1
    for i, text in {(i, t) for i, t in TEXTS if i not in (5,)}:
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        whole = [k for r in own for k in as_ids(r.ids)]
        assert whole == library_ids(text, 1) and {r.doc_tokens for r in own} == {len(whole)}
    assert sum(r.length for r in rows) == sum(len(library_ids(t, 1)) for _, t in TEXTS)
    assert pack(docs_of([])).count() == 0


def test_alike_pieces_meet_in_one_of_many_shards(docs_of):
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), 7)) for _ in range(4000)]
    topics = [list(rng.choice(words, 40, replace=False)) for _ in range(100)]
    rows = [(2 * k + j, " ".join(rng.permutation(topics[k])[:36])) for k in range(100) for j in range(2)]
    packed = pack(docs_of(rows), window=2048, shard_tokens=2048).collect()
    shards = {r.doc_id: r.sequence_id >> 32 for r in packed if r.start == 0}
    assert len(set(shards.values())) > 8
    assert sum(shards[2 * k] == shards[2 * k + 1] for k in range(100)) > 50
    assert sum(r.length for r in packed) == sum(len(library_ids(t, 1)) for _, t in rows)


def test_index_scores_match_a_plain_bm25():
    rng = np.random.default_rng(3)
    pieces = [rng.integers(0, 30, n) for n in (20, 5, 40, 1)]
    idf, mean = rng.random(30), 16.5
    index = InvertedIndex(pieces, idf, mean)
    for seed in pieces:
        got = index.scores(np.unique(seed))
        for k, p in enumerate(pieces):
            want = 0.0
            for t in set(seed.tolist()) & set(p.tolist()):
                tf = (p == t).sum()
                want += idf[t] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(p) / mean))
            assert got[k] == pytest.approx(want)


def test_seeds_take_their_best_neighbours():
    a, b = np.arange(0, 40), np.arange(100, 140)
    pieces = [a, b, a[:30], b[:30]]
    placed = list(fill_windows(pieces, InvertedIndex(pieces, np.ones(200), 35.0), 70))
    assert [(p, s) for p, _, _, s, _ in placed] == [(0, 0), (2, 0), (1, 1), (3, 1)]


def test_pieces_that_are_used_up_leave_the_index(monkeypatch):
    rng = np.random.default_rng(5)
    pieces = [rng.integers(0, 50, n) for n in rng.integers(5, 60, 80)]
    whole = InvertedIndex(pieces, rng.random(50), 32.0)
    asked, scores = [], InvertedIndex.scores

    def noted(index, terms):
        asked.append(len(index.piece))
        return scores(index, terms)

    monkeypatch.setattr(InvertedIndex, "scores", noted)
    index = InvertedIndex(pieces, np.ones(50), 32.0)
    got = list(fill_windows(pieces, index, 70))
    assert asked[0] == len(whole.piece) and asked[-1] < asked[0] / 4
    # The same as with the whole index to the end.
    monkeypatch.setattr(InvertedIndex, "keep", lambda index, wanted: None)
    assert got == list(fill_windows(pieces, InvertedIndex(pieces, np.ones(50), 32.0), 70))
    assert sum(last - first for _, first, last, _, _ in got) == sum(map(len, pieces))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_new_pieces_are_put_in_the_vocabularys_letters_at_once(name, monkeypatch):
    texts = ["", "  ", "\u00ff \u00fe'S it's", "caf\u00e9 \u4e2d  a\n\n b\x00", "words words more"]
    asked = []
    own = Encoder(public_tokenizers.path(name))
    new = own._new
    monkeypatch.setattr(own, "_new", lambda pieces: asked.append(len(pieces)) or new(pieces))
    whole = Encoder(public_tokenizers.path(name))
    assert own.encode(texts) == whole._whole(texts)
    assert len(asked) == 1 and own.encode(texts) == whole._whole(texts) and len(asked) == 1


def test_counts_of_flat_files(spark, docs_of, folder):
    import base64

    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(t): int(k) for t, k in map(bytes.split, lines)}
    plain = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = sorted((repr(r.doc_id), r.n_tokens) for r in corpus_token_counts(docs_of(TEXTS, "file document")).collect())
    assert got == sorted((repr(i), len(plain.encode_ordinary(t or ""))) for i, t in TEXTS)
    assert corpus_token_counts(docs_of([])).count() == 0


@pytest.mark.parametrize("block", [2, 4, 6, 64])
def test_documents_across_blocks(spark, folder, block):
    files = {"a.bin": [1, 2, 9, 9, 3, 3, 3, 3, 3, 9], "b.bin": [9, 4, 4], "c.bin": [5] * 7, "d.bin": []}
    for name, ids in files.items():
        with open(f"{folder}/{name}", "wb") as out:
            out.write(np.array(ids, "<u2").tobytes())
    listed = spark.createDataFrame([(n, 2 * len(i)) for n, i in files.items()], "file string, bytes long")
    got = sorted(tuple(r) for r in count_tokens(spark, folder, listed, separator=9, block_bytes=block).collect())
    assert got == [
        ("a.bin", 0, 0, 2, True), ("a.bin", 1, 3, 0, True), ("a.bin", 2, 4, 5, True),
        ("b.bin", 0, 0, 0, True), ("b.bin", 1, 1, 2, False), ("c.bin", 0, 0, 7, False),
    ]


def test_a_file_that_ends_within_an_id_raises(spark, folder):
    listed = spark.createDataFrame([("a.bin", 3)], "file string, bytes long")
    with pytest.raises(Exception, match="ends within an id"):
        count_tokens(spark, folder, listed).collect()


def test_packing_the_given_table_is_whole(spark, sf):
    from deskwise.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    ends = {r.doc_id: len(library_ids(r.text, 1)) for r in docs.collect()}
    rows = QUERIES["op1_lexical_packing"](spark, sf)
    got = rows.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()
    assert {r.doc_id: (r.n, r.t) for r in got} == {k: (n, n) for k, n in ends.items()}


@settings(deadline=None)
@given(st.lists(st.text("aZéñß'.,%#\n\t 1ªµ<|>_-Ωж", max_size=40), min_size=1, max_size=20))
def test_words_with_marks_have_the_ids_of_the_library(texts):
    texts = [*texts, "que,### naïve%%% don't word' l'été a_b <|endoftext|> x<|endoftext|>."]
    expected = [np.array(library_ids(t), "<u4").tobytes() for t in texts]
    assert ENCODER.encode(texts) == expected


def test_ids_stay_right_while_pieces_are_forgotten(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_PIECES", 20)
    monkeypatch.setattr(tokens, "GROUP_CHARS", 60)
    small = Encoder(PATH)
    texts = [" ".join(f"w{'abcdefg'[(k * j) % 7]}{'xyz'[j % 3] * (k % 5)}," for j in range(9)) for k in range(80)]
    texts += ODD + texts
    assert [as_ids(raw) for raw in small.encode(texts)] == [library_ids(t) for t in texts]
    assert small.older


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_known_pieces_are_few_bytes_in_arrow(name, monkeypatch):
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcdefghij"), 7)) for _ in range(6000)]
    own = Encoder(public_tokenizers.path(name))
    texts = [" ".join(words[k : k + 60]) for k in range(0, 6000, 60)]
    whole = own._whole(texts)
    assert own.encode(texts) == whole
    assert len(own.pieces) == len(own.ids) >= 6000 and own.met.all()
    assert own.pieces.nbytes + own.ids.nbytes < 50 * len(own.pieces)
    # What is met again stays, the rest is forgotten; the bound on bytes forgets all.
    monkeypatch.setattr(tokens, "KEPT_PIECES", 3000)
    assert own.encode(texts[:9]) == whole[:9] and own.older >= 6000
    assert own.encode(texts) == whole and own.encode(texts[:9]) == whole[:9]
    monkeypatch.setattr(tokens, "KEPT_BYTES", 1000)
    assert own.encode([texts[0], "x" * 3000]) == own._whole([texts[0], "x" * 3000])
    assert own.encode(["a", "", " "]) == own._whole(["a", "", " "]) and len(own.pieces) < 5


def test_terms_of_more_pieces_than_a_byte_counts():
    rng = np.random.default_rng(7)
    pieces = [np.append(rng.integers(0, 9 + k, rng.integers(0, 12)), 3).astype("<u4") for k in range(700)]
    rows = pa.RecordBatch.from_arrays([pa.array([p.tobytes() for p in pieces], pa.binary())], names=["ids"])
    (got,) = _frequencies(9)([rows])
    want = {N_PIECES: 700, N_TOKENS: sum(map(len, pieces)), N_REST: sum(len(p) for p in pieces if len(p) < 9)}
    for p in pieces:
        for term in set(p.tolist()):
            want[term] = want.get(term, 0) + 1
    assert want[3] == 700 and dict(zip(*(c.to_pylist() for c in got.columns), strict=True)) == want


TROUBLE = "  \n\t\r\x0b\x85\u00a0''" + "'sStTrReEvVlLmMdDaZ,.!#12é½²ßΣĀİ日€’한🙂\u0301\u0300ᄀ"


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(alphabet=TROUBLE, max_size=25), min_size=1, max_size=30))
def test_pieces_are_those_of_the_tokenizer(name, texts):
    encoder = tokens.encoder(name)
    texts = [*texts, "<|endoftext|>a <|startoftext|>", "it's'd''re we'LL 's", ""]
    whole = encoder.library.encode_batch_fast(texts, add_special_tokens=False)
    assert [as_ids(x) for x in encoder.encode(texts)] == [e.ids for e in whole]


def test_special_tokens_can_be_plain_text():
    plain = Encoder(PATH, plain_specials=True)
    text = "a <|endoftext|>"
    assert as_ids(plain.encode([text])[0]) == plain.library.encode(text, add_special_tokens=False).ids
    assert 50256 not in as_ids(plain.encode([text])[0])
