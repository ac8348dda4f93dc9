import base64
import hashlib
import re
import sys
import textwrap

import numpy as np
import pytest

import corpus_pipeline
from compare import connect, differences
from deskwise.llm import decontaminate as dec
from deskwise.llm import files
from deskwise.llm import warc
from deskwise.llm.licences import EQUIVALENT_SPELLINGS, KNOWN_LICENCES, TEXTS, digests_of, document_licences, find_licences, known_digests
from deskwise.llm.queries import ORACLE_SQL, QUERIES


def prose(n, seed, size=300):
    rng = np.random.default_rng(seed)
    words = ["".join(np.random.default_rng(k).choice(list("abcdefghij"), 6)) for k in range(size)]
    return " ".join(rng.choice(words, n))


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_sql(spark, sf, name):
    assert differences(QUERIES[name](spark, sf), connect(sf), ORACLE_SQL[name]) is None


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_items_are_found_where_they_are_pasted(spark, docs_of):
    items = [(k, f"{prose(20, 1000 + k)} now. {prose(15, 2000 + k)} then?") for k in range(60)] + [(60, None), (61, " .")]
    item = dict(items)
    rows = [
        (1, prose(400, 1)), (2, f"{prose(333, 2)} {item[7]} {prose(200, 3)}"), (3, item[8].upper()),
        (4, f"{prose(63, 4)} {item[9].replace('.', ' ...')}"), (5, None), (6, ""), (None, item[10]),
        (7, f"{item[11]} {prose(5000, 5)} {item[12]}"), (7, item[11]), (8, item[13].split(".")[0]),
        (9, " ".join(reversed(item[14].split()))),
    ]
    got = dec.contaminated(docs_of(rows, "item_id score"), items_of(spark, items))
    pairs = sorted(((r.doc_id or -1), r.item_id) for r in got.collect())
    assert pairs == [(-1, 10), (2, 7), (3, 8), (4, 9), (7, 11), (7, 11), (7, 12)]
    docs = docs_of(rows, "key_id")
    kept = dec.decontaminate(docs, items_of(spark, items))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 5, 6, 8, 9]
    assert dec.contaminated(docs_of([]), items_of(spark, items)).count() == 0
    assert dec.contaminated(docs, items_of(spark, [])).count() == 0
    assert dec.decontaminate(docs, items_of(spark, [])).count() == len(rows)


def test_whole_items_count_however_their_last_sentence_fares(spark, docs_of):
    items = [(k, f"{prose(40, 3000 + k)}. {prose(a, 4000 + k)}.") for k, a in enumerate([3, 12, 4, 12])]
    one_word = lambda k, n: " ".join("other" if i == n else w for i, w in enumerate(items[k][1].split()))
    rows = [
        (1, f"{prose(90, 1, 3000)} {one_word(0, 41)} {prose(90, 2, 3000)}"), (2, one_word(1, 46)),
        (3, f"{items[2][1].split('.')[0]} {prose(90, 3, 3000)}"), (4, items[3][1].split(".")[1]),
    ]
    got = dec.contaminated(docs_of(rows), items_of(spark, items)).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 0), (2, 1), (3, 2)]
    assert all(r.question_overlap == 1 and r.answer_overlap < dec.SIMILARITY for r in got)
    columns = [(k, *t.split(". ")) for k, t in items]
    apart = spark.createDataFrame(columns, "item_id long, question string, answer string")
    assert dec.contaminated(docs_of(rows), apart).count() == 3


def stored(indexes):
    folder, names = indexes
    return [dec.load_index(folder, name) for name in names]


def test_repeated_items_are_dealt_over_the_parts(spark):
    parts = stored(dec.store_indexes(items_of(spark, [(1, prose(20, 1))] * 60), index_words=300))
    assert len(parts) > 2 and sum(len(p.items) for p in parts) == 60
    assert max(len(p.items) for p in parts) < 40


def test_maxima_are_kept_for_blocks_with_postings_only(spark):
    rows = [(k, prose(20, k)) for k in range(64)]
    (index,) = stored(dec.store_indexes(items_of(spark, rows)))
    for t in range(0, len(index.number), 7):
        own = slice(index.first[t], index.first[t + 1])
        want = {}
        for item, weight in zip(index.item[own].tolist(), index.weight[own].tolist(), strict=True):
            want[item // dec.BLOCK_ITEMS] = max(weight, want.get(item // dec.BLOCK_ITEMS, 0))
        entries = slice(index.block_first[t], index.block_first[t + 1])
        assert dict(zip(index.block[entries].tolist(), index.block_most[entries].tolist(), strict=True)) == want
        assert index.most[t] == max(want.values())


def test_blocks_of_items_together_are_one_index(spark):
    rows = [(k, f"{prose(12, k)}. {prose(5, k + 500)}") for k in range(50)]
    (whole,) = stored(dec.store_indexes(items_of(spark, rows)))
    parts = stored(dec.store_indexes(items_of(spark, rows), index_words=200))
    assert len(parts) > 2 and sum(len(p.items) for p in parts) == 50
    words = dec.words_of(f"{rows[3][1]} {prose(300, 9)} {rows[40][1]}")
    one = {whole.items[i][0]: m for i, m in whole.matches(words).items()}
    many = {p.items[i][0]: m[:3] for p in parts for i, m in p.matches(words).items()}
    assert set(one) == set(many) == {3, 40}
    assert all(one[k][0] == pytest.approx(many[k][0]) for k in one)


def test_skipping_loses_nothing():
    rng = np.random.default_rng(2)
    items = [(k, dec.words_of(prose(int(rng.integers(3, 30)), k, 60)), dec.words_of(prose(3, 90 + k, 60))) for k in range(70)]
    df = {}
    for _, q, a in items:
        for w in {*q, *a}:
            df[w] = df.get(w, 0) + 1
    mean = sum(len(q) + len(a) for _, q, a in items) / len(items)
    index = dec.Index(items, len(items), mean, df)
    words = dec.words_of(prose(2000, 77, 60))
    codes = np.array([index.number.get(w, -1) for w in words])
    window, terms, heads = index.passages(codes)
    got = {(int(w), int(i)): s for w, i, s in zip(*index.search(window, terms, heads), strict=True)}
    weight = np.zeros((len(items), len(index.number)))
    for t in range(len(index.number)):
        s = slice(index.first[t], index.first[t + 1])
        weight[index.item[s], t] = index.weight[s]
    size, want = index.longest + dec.STRIDE, {}
    for w in range(-(-(len(words) - index.longest) // dec.STRIDE)):
        own = sorted({c for c in codes[w * dec.STRIDE : w * dec.STRIDE + size].tolist() if c >= 0})
        scores = weight[:, own].sum(axis=1)
        want |= {(w, i): scores[i] for i in np.flatnonzero(scores >= index.threshold).tolist()}
    assert set(got) == set(want) and len(want) > 5
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_question_and_answer():
    assert dec.question_and_answer("What is it? A b. The end.") == ("What is it? A b.", "The end.")
    assert dec.question_and_answer("Just one") == ("Just one", "")
    assert dec.question_and_answer("") == ("", "")


def test_licences_in_other_spellings(spark, docs_of):
    mit = "Copyright (c) 2020 Someone\n\n" + next(t for n, t in __import__("deskwise.llm.licences").llm.licences.KNOWN_LICENCES if n == "MIT" and len(t) > 200)
    rows = [
        (1, mit.upper()), (2, mit.replace("sublicense", "sublicence").replace('"', "“")), (3, mit + "\nAnd more."),
        (4, "a\n  released under the MIT Licence!\nb"), (5, None), (6, ""), (7, "© all mine"), (8, "a\nReleased under the MIT License."),
        (8, "a\nReleased under the MIT License."), (None, "Licensed under CC BY-NC 4.0"),
    ]
    got = sorted(((r.doc_id or -1), r.line or 0, r.licence) for r in document_licences(docs_of(rows, "line digest")).collect())
    assert got == [
        (-1, 0, "CC-BY-NC-4.0"), (-1, 1, "CC-BY-NC-4.0"), (1, 0, "MIT"), (2, 0, "MIT"), (4, 2, "MIT"), (8, 2, "MIT"), (8, 2, "MIT"),
    ]
    assert document_licences(docs_of([])).count() == 0


def test_whole_licence_files_are_found(spark, docs_of, folder):
    mine = "Copyright (c) 2020 Someone"
    mit = next(t for n, t in KNOWN_LICENCES if n == "MIT" and "\n" in t)
    files = {f.stem: f.read_text() for f in sorted(TEXTS.glob("*.txt"))}
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "Zlib", "Unlicense", "GPL-2.0", "GPL-3.0"} <= set(files)
    want = [("MIT", f"MIT License\n\n{mine}\n\n{mit}"), ("MIT", f"The MIT License (MIT)\n{mine}\n\n{mit}")]
    for name, text in files.items():
        title, body = text.split("\n\n", 1)
        want += [(name, text), (name, f"{title}\n\n{mine}\n\n{body}"), (name, f"{mine}\n\n{body}")]
    rows = list(enumerate(t for _, t in want))
    got = {r.doc_id: r.licence for r in document_licences(docs_of(rows)).where("line is null").collect()}
    assert got == dict(enumerate(n for n, _ in want))
    spark.createDataFrame([("own", "My own terms.")], "licence string, known string").write.parquet(f"{folder}/known")
    known = digests_of(spark.read.parquet(f"{folder}/known"))
    assert [r.licence for r in document_licences(docs_of([(1, "MY OWN TERMS")]), known).where("line is null").collect()] == ["own"]


def test_wraps_and_phrases_do_not_matter(spark, docs_of):
    def wrapped(text, width):
        # Paragraphs with a notice stay as they are: notices are lines.
        parts = re.split(r"\n\s*\n", text)
        return "\n\n".join(p if re.search(r"(?i)copyright (\(c\)|\[)", p) else textwrap.fill(" ".join(p.split()), width, break_long_words=False) for p in parts)

    full = [(n, t) for n, t in KNOWN_LICENCES if "\n" in t]
    mine = ["Copyright (c) 2020 Someone", "© Someone\nAll rights reserved.", "Copyright 2019, 2020 A and B", "Copyright Someone, Inc. and others"]
    want = [(n, f"{mine[k % 4]}\n\n{wrapped(t, width)}") for width in (30, 47, 64, 72, 79, 100) for k, (n, t) in enumerate(full)]
    changes = [("copyright owner", "copyright holder"), ("non-commercial", "noncommercial"), ("sublicens", "sub-licens"), ("percent", "per cent"), ("https:", "http:")]
    want += [(n, t.replace(a, b)) for n, t in full for a, b in changes if a in t]
    got = document_licences(docs_of(list(enumerate(t for _, t in want)))).where("line is null").collect()
    assert {r.doc_id: r.licence for r in got} == dict(enumerate(n for n, _ in want))
    assert {a for a, _ in changes if any(a in t for _, t in full)} == {a for a, _ in changes}


def test_spellings_are_words_for_words(spark):
    assert all(" " not in x for pair in EQUIVALENT_SPELLINGS.items() for x in pair)
    known = known_digests(spark, [("b", "the licence"), ("a", "The License")])
    assert [r.licence for r in known.collect()] == ["a"]
    texts = spark.createDataFrame([(1, "THE LICENSE.")], "k int, t string")
    assert [(r.k, r.licence) for r in find_licences(texts, ["k"], "t", known).collect()] == [(1, "a")]


PAGES = [
    (4, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (9, "http://a b\r\n/é", "<p>same</p>"), (3, None, None),
    (5, "u", ""), (6, "u", "own é\r\n\r\nbody"), (7, "u", "x" * 300_000), (8, "u", "twice"), (8, "u", "twice"),
    (None, "u", "twice"), (None, None, "no id"), (None, None, "no id"),
]


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")


def sha(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_archives_round_trip(spark):
    got = warc.archive_pages(pages_of(spark, PAGES)).collect()
    seen = sorted(((r.page_id or -1), r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in got if r.page_id)
    want = sorted(
        (i, "response" if first is None else "revisit", first, len((h or "").encode()), sha(h))
        for (i, _, h), first in zip(PAGES[:9], [2, None, 2, None, 3, None, None, None, 8], strict=True)
    )
    assert sorted(seen, key=repr) == sorted(want, key=repr)
    unnamed = sorted((r.payload_digest, r.record_type, r.refers_to) for r in got if r.page_id is None)
    assert unnamed == sorted([(sha("twice"), "revisit", 8), (sha("no id"), "response", None), (sha("no id"), "revisit", None)])
    assert {bytes(r.payload) for r in got if r.page_id in (6, 7)} == {b"own \xc3\xa9\r\n\r\nbody", b"x" * 300_000}
    assert all(r.payload is None for r in got if r.record_type == "revisit")
    assert warc.archive_pages(pages_of(spark, [])).count() == 0


def test_small_payloads_are_not_revisited(spark, folder):
    manifest = warc.write_archives(pages_of(spark, PAGES), f"{folder}/w", revisit_bytes=11, roll_bytes=1)
    kinds = {r.page_id: r.record_type for r in warc.read_archives(spark, f"{folder}/w", manifest).collect()}
    assert (kinds[4], kinds[5], kinds[8]) == ("revisit", "response", "response")
    assert manifest.count() == len(PAGES)


def test_archives_are_the_same_bytes_and_verified(spark, folder):
    import gzip

    pages = pages_of(spark, PAGES)
    one = warc.write_archives(pages, f"{folder}/a").select("file", "sha1", "bytes").collect()
    two = warc.write_archives(pages, f"{folder}/b").select("file", "sha1", "bytes").collect()
    assert sorted(one) == sorted(two)
    for r in one:
        raw = open(f"{folder}/a/{r.file}", "rb").read()
        assert hashlib.sha1(raw).hexdigest() == r.sha1 and len(raw) == r.bytes
        assert gzip.decompress(raw).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    name = max(one, key=lambda r: r.bytes).file
    broken = bytearray(open(f"{folder}/a/{name}", "rb").read())
    broken[len(broken) // 2] ^= 255
    open(f"{folder}/a/{name}", "wb").write(broken)
    manifest = spark.createDataFrame([(name,)], "file string")
    with pytest.raises(Exception, match="error|digest|WARC"):
        warc.read_archives(spark, f"{folder}/a", manifest).collect()


def test_pipeline_keeps_clean_documents(spark, docs_of, sf):
    clean = [(k, prose(120, 300 + k, 3000)) for k in range(30)]
    item = spark.read.parquet(f"{sf}/benchmark.parquet").first().text
    shared = prose(60, 999, 3000) + "."
    rows = clean + [
        (40, "spam spam eggs " * 50), (41, None), (42, clean[0][1]), (43, f"{prose(80, 55, 3000)} {item} {prose(80, 56, 3000)}"),
        (44, f"{prose(90, 57, 3000)}\n{shared}"), (45, f"{prose(90, 58, 3000)}\n{shared}"), (None, prose(100, 59, 3000)),
    ]
    docs, kept = docs_of(rows, "row shard"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = corpus_pipeline.held(stage(spark, docs, sf), name)
        assert docs.columns == columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    assert set(kept["quality_rules"]) == {i for i, _ in rows} - {40, 41}
    assert set(kept["near_duplicates"]) == set(kept["quality_rules"]) - {42}
    assert shared in kept["repeated_passages"][44] and shared not in kept["repeated_passages"][45]
    assert set(kept["benchmark_leaks"]) == set(kept["near_duplicates"]) - {43}
    assert all(kept["benchmark_leaks"][i] == t for i, t in clean)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id for r in packed} == set(kept["benchmark_leaks"])


def test_pipeline_runs_on_the_given_tables(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 100
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "repeated_passages", "benchmark_leaks", "packed_sequences",
    ]


def test_the_entry_offers_all(spark):
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14)) and "pipeline" in entry.queries()
    assert "deskwise.llm" in sys.modules


@pytest.mark.parametrize("uri, known", [("s3a://b/k", "s3://b/k"), ("file:/tmp/x", "file:/tmp/x"), ("hdfs://h:1/x", "hdfs://h:1/x")])
def test_schemes_of_spark_are_known_to_arrow(uri, known):
    assert files.known_uri(uri) == known
