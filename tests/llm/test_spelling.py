"""Spelling variants against words compared with all others."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from deskwise.llm import spelling
from deskwise.llm.spelling import Grams, longest_chain, near_words, spelling_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(docs):
    counts = Counter()
    for name, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWERED)
            h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    """Exactly one, for different words."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(a == b[:k] + b[k + 1 :] for k in range(len(b)))


def plain_variants(words):
    near = {w: [u for u in words if u != w and one_edit(u, w)] for w in words}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda u: (-words[u], u))
            if words[best] >= 5 * words[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def variants(docs, **more):
    return {tuple(r) for r in spelling_variants(docs, **more).collect()}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aZ Àÿ×Ā¿.\x00日🙂Kk", max_size=30), max_size=6))
def test_runs_and_their_hashes(texts):
    texts = [*texts, "ABCDEFG ÉtésÿÀx" * 3]
    ids = [None, *range(1, len(texts))]
    runs, crc = spelling.runs_of([t.encode() for t in texts], ids)
    want = [
        (run, zlib.crc32(f"{'' if k is None else k}:{run}".encode()))
        for k, t in zip(ids, texts, strict=True)
        for run in (r.translate(LOWERED) for r in RUN.findall(t))
        if len(run.encode()) >= 6
    ]
    assert list(zip(runs.to_pylist(), crc.tolist(), strict=True)) == want


def test_runs_longer_than_the_vectorised_bytes():
    texts = ["x" * n for n in (63, 64, 65, 1000)]
    runs, crc = spelling.runs_of([t.encode() for t in texts], [9] * 4)
    assert crc.tolist() == [zlib.crc32(f"9:{t}".encode()) for t in texts]


def edits(word, letters="abcz"):
    for k in range(len(word) + 1):
        for c in letters:
            yield word[:k] + c + word[k:]
            yield word[:k] + c + word[k + 1 :]
        yield word[:k] + word[k + 1 :]


@settings(max_examples=80, deadline=None)
@given(
    st.text(alphabet="abc", min_size=6, max_size=10),
    st.sets(st.text(alphabet="^abc$", min_size=3, max_size=5), max_size=60),
)
def test_no_edit_affects_more_grams_than_the_bound(word, longer):
    grams = Grams({g: 1 for g in longer}, 5)
    own = grams.decompose(word)
    bound = grams.affected(word, own)
    mine = Counter(g for _, g in own)
    for other in set(edits(word)) - {word}:
        theirs = Counter(g for _, g in grams.decompose(other))
        assert len(own) - (mine & theirs).total() <= bound


LETTERS = np.array(list("abcde"))


def vocabulary(n, seed):
    rng = np.random.default_rng(seed)
    words = {"".join(rng.choice(LETTERS, rng.integers(6, 9))) for _ in range(n)}
    words |= {"éèaaaa", "éêaaaa", "éaaaaÿ", "aaaaaaaa", "aaaaaaa", "abababab", "babababa"}
    return {w: int(rng.integers(5, 2000)) for w in words}


@pytest.mark.parametrize("longest, selective", [(2, 1), (3, 1), (4, 1), (4, 10), (4, 500), (5, 3), (6, 1)])
def test_near_words_for_any_dictionary(spark, longest, selective):
    words = vocabulary(1500, longest)
    table = spark.createDataFrame(sorted(words.items()), "word string, n long")
    got = sorted((min(r.a, r.b), max(r.a, r.b)) for r in near_words(table, longest, selective).collect())
    ordered = sorted(words)
    assert got == [(a, b) for i, a in enumerate(ordered) for b in ordered[i + 1 :] if one_edit(a, b)]


def test_the_dictionary_keeps_to_its_size(spark):
    table = spark.createDataFrame(sorted(vocabulary(800, 1).items()), "word string, n long")
    whole, small = (spelling.gram_dictionary(table, 4, 1, most) for most in (10**6, 50))
    assert len(small.longer) <= 50 < len(whole.longer)
    shortest = {g for g in whole.counts if len(g) == 2}
    assert shortest == {g for g in small.counts if len(g) == 2}


def test_chains_of_forms(spark):
    """Each five times as frequent as the one before it."""
    chain = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb", "abbbbb"]
    text = " ".join(w for k, w in enumerate(chain) for _ in range(5 * 5**k))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = variants(docs)
    assert got == plain_variants(plain_words([(1, text)]))
    assert len({r[2] for r in got}) == 1


def test_steps_cover_the_longest_chain():
    for most in (5, 24, 25, 124, 125, 3124, 3125, 10**9):
        length, n = 0, 5
        while n * 5 <= most:
            length, n = length + 1, n * 5
        assert longest_chain(most) >= max(1, length)


def test_nulls_empty_and_long_texts_and_repeated_rows(spark):
    rows = [
        (None, "Straße Straße strasse straße"), (3, None), (3, ""), (4, " 12 ."), (5, "y" * 200_000),
        (6, "colour COLOUR color-colour colour colours"), (6, "colour COLOUR color-colour colour colours"),
        (7, "colours " * 6 + "colour " * 40 + "ÉCOLES Écoles écoles " * 5),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert variants(docs) == plain_variants(plain_words(rows))
    assert variants(docs.where("false")) == set()


def test_extra_columns_do_not_matter(spark):
    rows = [(k, "letter letters lettered " * 4) for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plain = variants(docs)
    for name in ("word", "n", "a", "b", "gram", "list", "entry", "a.b", "WORD"):
        docs = docs.selectExpr("*", f"'x' as `{name}`")
    assert variants(docs) == plain == plain_variants(plain_words(rows))


def test_the_given_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert variants(docs) == plain_variants(plain_words(rows))
