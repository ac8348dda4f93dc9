import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from deskwise.llm import sharding
from deskwise.llm.queries import QUERIES
from deskwise.llm.repetition import MEASURES, measure, repetition
from deskwise.llm.sharding import stratified_shards
from deskwise.llm.simhash import (
    components, fingerprint, fingerprint_groups, keep_one_per_group, linked_groups, near_duplicates, retained, tally,
)
from deskwise.llm.substrings import MIN_WORDS, cut_spans, occurrences, remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RNG = np.random.default_rng(5)
WORDS = ["".join(RNG.choice(list("abcdefgh"), 5)) for _ in range(400)]


def prose(n, seed):
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


def plain_fingerprint(text, n=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = WORD.findall(lowered)
    if not words:
        return 0
    grams = [" ".join(words[k : k + n]) for k in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet=st.sampled_from("aBÉé \t\n\x0b\x1c z"), max_size=60))
def test_fingerprint_by_the_definition(text):
    assert fingerprint(text) == plain_fingerprint(text)


def union(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2**16 - 1), min_size=2, max_size=60))
def test_links_within_a_posting_list(numbers):
    members = np.array(sorted(numbers))
    links = [(i, j) for i in range(len(members)) for j in range(i) if int(members[i] ^ members[j]).bit_count() <= 2]
    want = union([*links, *((k, k) for k in range(len(members)))])
    assert linked_groups(members).tolist() == [want[k] for k in range(len(members))]


def test_components_of_chains_stars_and_rings(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(200, 201), (201, 202), (202, 200)]
    frame = spark.createDataFrame([(b, a) if a % 3 else (a, b) for a, b in links], "a long, b long")
    want = {n: r for n, r in union(links).items() if n != r}
    assert {r.node: r.root for r in components(frame).collect()} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_groups_against_all_pairs(spark):
    rng = np.random.default_rng(9)
    seeds = rng.integers(0, 2**63, 30, dtype=np.uint64)
    values = {int(s) for s in seeds} | {0, 1, 2**64 - 1}
    for s in seeds.tolist():
        for _ in range(12):
            x = s
            for b in rng.choice(64, int(rng.integers(1, 5)), replace=False).tolist():
                x ^= 1 << b
            values.add(x)
    values = sorted(values)
    links = [(a, b) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= 2]
    want = union([*links, *((v, v) for v in values)])
    signed = [(v - 2**64 if v >= 2**63 else v,) for v in values]
    got = fingerprint_groups(spark.createDataFrame(signed, "fingerprint long")).collect()
    groups = defaultdict(set)
    for r in got:
        groups[r.group].add(r.fingerprint % 2**64)
    wanted = defaultdict(set)
    for v, r in want.items():
        wanted[r].add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


DOCS = [
    (7, prose(300, 1)), (3, prose(300, 1)), (9, prose(300, 1).upper()), (5, None), (6, ""), (8, " \n"),
    (None, prose(300, 1)), (None, "only without an id"), (4, "one word"), (4, "one word"), (10, prose(5000, 3)),
]


def test_near_duplicates_of_odd_rows(docs_of):
    got = [(r.doc_id, r.component_id) for r in near_duplicates(docs_of(DOCS, "fingerprint group first")).collect()]
    want = [(None, None), (None, 3), (3, 3), (4, 4), (4, 4), (5, 5), (6, 5), (7, 3), (8, 5), (9, 3), (10, 10)]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    prints = {r.doc_id: r.fingerprint for r in near_duplicates(docs_of(DOCS)).collect()}
    assert prints[10] == f"{plain_fingerprint(prose(5000, 3)):016x}" and prints[5] == "0" * 16
    assert near_duplicates(docs_of([])).count() == 0


def test_one_of_each_group_stays(docs_of):
    docs = docs_of(DOCS, "key_id group")
    kept = keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 3, 4, 5, 10]
    assert keep_one_per_group(docs_of([])).count() == 0


def test_repeated_passages_go_and_first_ones_stay(docs_of):
    passage = "Alpha beta gamma delta. Epsilon zeta eta theta iota kappa lambda mu. Nu xi omicron pi rho sigma tau upsilon phi."
    own = [prose(60, k) for k in range(5)]
    rows = [
        (1, f"{own[0]} {passage} {own[1]}\nsecond line"), (2, f"{own[2]}\n{passage.replace('mu.', 'mu!')}\n{own[3]}"), (3, f"{passage} {own[4]}"),
        (4, "Short line."), (5, "Short line."), (6, None), (7, ""), (None, passage), (8, f"{passage}\n{passage}"),
        (9, prose(40, 77)), (9, prose(40, 77)),
    ]
    docs = docs_of(rows, "begin high removed")
    cut = remove_repeats(docs)
    assert cut.columns == [c for c in docs.columns if c != "removed"] + ["removed"]
    texts = defaultdict(list)
    originals = defaultdict(list)
    for i, t in rows:
        originals[i].append(t)
    for r in cut.collect():
        texts[r.doc_id].append(r.text)
        whole = originals[r.doc_id][0]
        if r.removed:
            at, kept = 0, ""
            for s in r.removed:
                kept += whole[at : s.begin]
                at = s.until
            assert kept + whole[at:] == r.text
        else:
            assert r.text in originals[r.doc_id]
    assert texts[1] == originals[1] and texts[2] == [f"{own[2]}\n{own[3]}"] and texts[3] == [own[4]]
    assert texts[4] == texts[5] == ["Short line."] and texts[6] == [None] and texts[7] == [""]
    assert texts[None] == [""] and texts[8] == [""] and texts[9] == originals[9]
    assert remove_repeats(docs_of([])).count() == 0


CAPITALS = {c for c in map(chr, [*range(65, 91), *range(0xC0, 0xD7), *range(0xD8, 0xDF), *range(0x391, 0x3AA), *range(0x410, 0x430)])}


def plain_units(text):
    """Begin, end and words of the units of each line: cut character by character."""
    lines, at = [], 0
    for line in text.split("\n"):
        cuts, i = [], 0
        while i < len(line):
            before = line[i - 1] if i else ""
            if line[i] in " \t\r\x0b\x0c" and before in (".", "!", "?"):
                j = i
                while j < len(line) and line[j] in " \t\r\x0b\x0c":
                    j += 1
                cuts.append((i, j))
                i = j
                continue
            if line[i] == " " and before and not before.isspace() and before not in ".!?" and line[i + 1 : i + 2] in CAPITALS:
                cuts.append((i, i + 1))
            i += 1
        units, begin = [], 0
        for end, after in [*cuts, (len(line), len(line))]:
            lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in line[begin:end])
            words = "".join(c for c in lowered if c not in string.punctuation).split()
            if words:
                units.append((at + begin, at + end, words))
            if units:
                begin = after
        lines.append(units)
        at += len(line) + 1
    return lines


def plain_occurrences(text, least=8):
    """(words, begin, end) of what is compared: lines, units, and short units joined with their neighbours."""
    lines = plain_units(text)
    units = [u for line in lines for u in line]
    found = set()

    def add(run):
        found.add((" ".join(w for u in run for w in u[2]), run[0][0], run[-1][1]))

    def size(run):
        return sum(len(u[2]) for u in run)

    for k in range(len(units)):
        ahead = next((units[k:j] for j in range(k + 1, len(units) + 1) if size(units[k:j]) >= least), None)
        back = next((units[j : k + 1] for j in range(k, -1, -1) if size(units[j : k + 1]) >= least), None)
        for run in (ahead, back):
            if run:
                add(run)
    if "\n" in text:
        for line in lines:
            if line:
                add(line)
    return sorted(found, key=lambda f: (f[1], -f[2]))


def test_spans_of_the_given_table_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = sorted(docs.collect())
    seen, spans = set(), defaultdict(list)
    for r in rows:
        for words, begin, end in plain_occurrences(r.text):
            if words in seen:
                spans[r.doc_id].append((begin, end))
            seen.add(words)
    want = {r.doc_id: cut_spans(r.text, sorted(set(spans[r.doc_id])))[0] for r in rows}
    assert sum(t != r.text for (t, r) in zip(want.values(), rows, strict=True)) > 20
    assert {r.doc_id: r.text for r in remove_repeats(docs).collect()} == want


def test_short_units_join_their_followers():
    text = "One two. Three four five. Six seven eight nine ten eleven twelve thirteen. Tail."
    found = [text[a:b] for _, _, a, b in occurrences(text)]
    assert found[0] == text[: text.index(" Tail")] and found[-1] == text[text.index("Six") : text.index(" Tail")]
    assert all(len(WORD.findall(t)) >= MIN_WORDS for t in found)


def test_short_lines_and_tails_go_too(docs_of):
    own = [prose(30, 60 + k) for k in range(8)]
    tail = "Alpha beta gamma delta epsilon zeta eta theta iota. Kappa lambda."
    rows = [
        (1, f"{own[0]}\nShare this.\n{own[1]}\n  - 所有文字都在这里。\n{own[2]}"),
        (2, f"Share this\n{own[3]}\n所有文字都在这里。\n{own[4]}\nSHARE THIS!"), (3, "Share this."),
        (4, f"{own[5]} {tail}"), (5, f"{own[6]}\n{tail}"), (6, f"{own[7]}. {tail} Mu."),
    ]
    got = {r.doc_id: r.text for r in remove_repeats(docs_of(rows)).collect()}
    assert got == dict(rows) | {2: f"{own[3]}\n{own[4]}\n", 5: f"{own[6]}\n", 6: f"{own[7]}. Mu."}


def plain_measures(text):
    words = WORD.findall(text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    n = Counter(windows)
    hit = {k + j for k, w in enumerate(windows) if n[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    again = sum(lines[k] in lines[:k] for k in range(len(lines)))
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), again, len(hit)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=st.sampled_from("aé \n\t#|\x1cb"), max_size=120))
def test_base_measures_by_their_definitions(text):
    got = dict(zip(MEASURES, measure(text), strict=True))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert tuple(got[n] for n in names) == plain_measures(text)


def test_verdicts(docs_of):
    clean, line = prose(200, 11), prose(30, 12)
    rows = [
        (1, clean), (2, None), (3, ""), (4, "few words"), (5, "same words here " * 40), (6, f"{line}\n" * 2 + prose(60, 13)),
        (7, clean), (7, clean), (None, prose(9000, 14)),
    ]
    got = sorted(((r.doc_id or -1), r.base_failed, r.kept) for r in repetition(docs_of(rows, "n_words kept")).collect())
    assert got == [
        (-1, False, True), (1, False, True), (2, True, False), (3, True, False), (4, True, False), (5, True, False),
        (6, False, False), (7, False, True), (7, False, True),
    ]
    assert repetition(docs_of([])).count() == 0


def plain_shards(rows, shards, seed=42):
    """(doc_id, size, crc, shard, slot): hash, rank per source, sort by fraction, cut."""
    ranked, seen = [], Counter()
    for source in {r[2] for r in rows}:
        own = []
        for name, text, s in rows:
            if s == source:
                seen[name, text or "", s] += 1
                raw = (text or "").encode()
                h = xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), 42)
                if name is not None:  # a null leaves the hash as it is
                    h = xxhash.xxh64_intdigest(name.to_bytes(8, "little", signed=True), h)
                h = xxhash.xxh64_intdigest(raw, h)
                if (copy := seen[name, text or "", s]) > 1:
                    h = xxhash.xxh64_intdigest(h.to_bytes(8, "little"), 42)
                    h = xxhash.xxh64_intdigest(copy.to_bytes(8, "little"), h)
                own.append((h >> 1, name is not None, name or 0, zlib.crc32(raw), name, len(raw) + 8))
        own.sort()
        ranked += [((k + 0.5) / len(own), source or "", source is None, *r[3:]) for k, r in enumerate(own)]
    ranked.sort(key=lambda r: r[:3])
    out, n = [], len(ranked)
    for at, (_, source, absent, crc, name, size) in enumerate(ranked):
        shard = at * shards // n
        first = -(-shard * n // shards)
        out.append((name, None if absent else source, size, crc, shard, at - first))
    return sorted(out, key=repr)


def test_every_column_of_the_shards_against_a_plain_version(spark, sf, docs_of):
    rows = [(k, f"tÉ{k}", ["a", "b", None, ""][k % 4]) for k in range(300)] + [(7, "x", "a")] * 3 + [(None, None, "b")]
    given = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()]
    for some, shards in ((rows, 24), (rows, 7), (given, 24)):
        for cell_rows in (16, 4096):
            got = stratified_shards(docs_of(some), shards, cell_rows=cell_rows).collect()
            got = sorted(((r.doc_id, r.source, r.size, r.text_crc32, r.shard, r.slot) for r in got), key=repr)
            assert got == plain_shards(some, shards)


def test_a_row_that_repeats_spreads_like_others(docs_of, monkeypatch):
    monkeypatch.setattr(sharding, "LISTED", 64)
    rows = [(1, "same", "hot")] * 1000 + [(k, f"t{k}", "other") for k in range(500)]
    got = stratified_shards(docs_of(rows), 10, cell_rows=50).collect()
    assert sorted(((r.doc_id, r.source, r.size, r.text_crc32, r.shard, r.slot) for r in got), key=repr) == plain_shards(rows, 10)
    per_shard = Counter(r.shard for r in got if r.source == "hot")
    assert len(per_shard) == 10 and max(per_shard.values()) - min(per_shard.values()) <= 2


def test_the_query_of_the_shards_keeps_its_contract(spark, sf):
    got = QUERIES["op8_stratified_shards"](spark, sf)
    kinds = {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"}
    assert {n: t for n, t in got.dtypes if n in kinds} == kinds
    assert [tuple(r) for r in got.select("law", "grown_shard").distinct().collect()] == [("rows", None)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=4)), min_size=1, max_size=20))
def test_the_tally_counts_equal_positions(pairs):
    left = np.array([a for a, _ in pairs], np.uint64)
    right = np.array([a ^ sum(1 << b for b in flips) for a, flips in pairs], np.uint64)
    equal = [sum(x == y for x, y in zip(int(a).to_bytes(8, "big"), int(b).to_bytes(8, "big"), strict=True)) for a, b in zip(left, right, strict=True)]
    assert tally(left, right).tolist() == equal
    assert retained(left, right).tolist() == [len(flips) <= 2 for _, flips in pairs]


def test_shards_hold_the_mixture(docs_of):
    rows = [(k, f"t{k}", "big" if k % 3 else ("small" if k % 2 else None)) for k in range(700)] + [(5, "t5", "big")] * 3
    rows += [(None, None, "big"), (1000, "x" * 10000, "tiny")]
    docs = docs_of(rows, "cell rank shard")
    got = stratified_shards(docs, 24, cell_rows=50).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    sizes = [len(v) for v in by.values()]
    assert len(by) == 24 and max(sizes) - min(sizes) <= 1
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in by.values())
    for source in ("big", "small", None):
        counts = [sum(r.source == source for r in v) for v in by.values()]
        assert max(counts) - min(counts) <= 2
    again = stratified_shards(docs.repartition(7), 24, cell_rows=50).collect()
    place = lambda rows: sorted((repr(r.doc_id), r.shard) for r in rows)
    assert place(got) == place(again)
    assert place(got) == place(stratified_shards(docs, 24, cell_rows=10_000).collect())
    assert stratified_shards(docs_of([]), 24).count() == 0
    assert sorted(r.shard for r in stratified_shards(docs_of([(1, "a"), (2, "b")]), 24).collect()) == [0, 12]
