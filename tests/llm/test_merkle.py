"""The manifest against a plain version: trees of lists, proofs by walking up."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from deskwise.llm.merkle import FIELDS, folded, manifest, proof_digest, verified_documents

LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def record(values):
    return digest("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def plain_tree(leaves, arity):
    nodes, steps, at = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            first = i - i % arity
            run = nodes[first : first + arity]
            steps[k].append((run[: i - first], run[i - first + 1 :]))
            at[k] = i // arity
        nodes = [digest(nodes[k : k + arity]) for k in range(0, len(nodes), arity)]
    return nodes[0], steps


def plain_manifest(rows, arity=16):
    """(row, leaf, subroot, root, proof, folded, verified) of tuples in the order of FIELDS."""
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        own = sorted(by_source[source], key=lambda r: (r[0] is not None, r[0] or 0, record(r)))
        trees[source] = own, *plain_tree([record(r) for r in own], arity)
    root, above = plain_tree([trees[s][1] for s in sources], arity) if rows else (None, [])
    out = []
    for source, upper in zip(sources, above, strict=True):
        own, subroot, steps = trees[source]
        for row, lower in zip(own, steps, strict=True):
            path, leaf = lower + upper, record(row)
            node = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                node = record((*row[:4], row[4] and row[4].translate(LOWERED)))
            for before, after in path:
                node = digest([*before, node, *after])
            proof = digest(d for before, after in path for d in before + after)
            out.append((row[0], leaf, subroot, root, proof, node, node == root))
    return out


def spark_manifest(docs, arity=16):
    done = verified_documents(docs, arity).withColumn("proof_sha256", proof_digest(F.col("path")))
    return sorted((tuple(r) for r in done.select("doc_id", *COLUMNS).collect()), key=repr)


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")


def sample(n, sources):
    return [(7 * k % 1009, sources[k % len(sources)], "en", k, f"Text {k} É") for k in range(n)]


@pytest.mark.parametrize("arity, n", [(2, 1), (2, 17), (3, 70), (16, 16), (16, 90)])
def test_trees_of_several_heights(spark, arity, n):
    rows = sample(n, ["b", "a", "a", "é", "z"])
    assert spark_manifest(documents(spark, rows), arity) == sorted(plain_manifest(rows, arity), key=repr)


def test_more_sources_than_a_run_and_a_hot_one(spark):
    rows = sample(400, [f"s{k}" for k in range(40)]) + [(5000 + k, "hot", "en", 1, "Same text") for k in range(300)]
    assert spark_manifest(documents(spark, rows)) == sorted(plain_manifest(rows), key=repr)


def test_nulls_ties_repeated_rows_and_long_texts(spark):
    rows = [
        (None, None, None, None, None), (None, None, None, None, None), (5, "", "en", 0, ""), (5, "", "en", 0, None),
        (5, None, "en", 3, "ABC"), (5, None, "en", 3, "ABC"), (10, "a", "é", -1, "X" * 300_000), (0, "a", "-", 1, "-"),
    ]
    assert spark_manifest(documents(spark, rows)) == sorted(plain_manifest(rows), key=repr)


def test_an_empty_table_gives_no_rows(spark):
    assert spark_manifest(documents(spark, []).where("false")) == []


def test_extra_columns_do_not_matter(spark):
    rows = sample(40, ["a", "b"])
    docs = documents(spark, rows)
    for name in ("tree", "idx", "n", "digest", "row", "path", "leaf", "root", "subroot", "a.b", "salt", "key_0", "ROW"):
        docs = docs.withColumn(name, F.lit("x"))
    assert spark_manifest(docs) == sorted(plain_manifest(rows), key=repr)


def test_the_callers_columns_stay(spark):
    rows = documents(spark, sample(20, ["a", "b"])).withColumns(
        {"leaf": F.sha2("text", 256), "idx": F.lit(1), "n": F.lit(2), "row": F.lit(3), "path": F.lit("given way")}
    )
    got = manifest(rows, "source", ["doc_id"])
    assert got.columns == ["doc_id", "source", "lang", "n_chars", "text", "idx", "n", "row", "leaf", "subroot", "root", "path"]
    assert got.where((F.col("idx") == 1) & (F.col("n") == 2) & (F.col("row") == 3)).count() == 20
    assert got.where(folded(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0


def test_every_field_is_covered(spark):
    row = (1, "s", "en", 2, "ab")
    changed = [(2, *row[1:]), (1, "t", *row[2:]), (*row[:2], None, *row[3:]), (*row[:3], 3, "ab"), (*row[:4], "a")]
    leaves = {record(r) for r in [row, *changed]}
    assert len(leaves) == 1 + len(FIELDS)
    got = spark_manifest(documents(spark, [row, *changed]))
    assert {r[1] for r in got} == leaves


def test_the_given_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select(*FIELDS).collect()]
    assert spark_manifest(docs) == sorted(plain_manifest(rows), key=repr)
