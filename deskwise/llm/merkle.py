"""Merkle manifest of a dataset: a tree of digests per source, and one over the sources' subroots.

Rows become leaves; within a source every run of ``arity`` consecutive nodes becomes the digest of the
run, until one node is left. No run is ever gathered by a driver or a single task: at each level a node
computes the indices of its siblings (XOR 1 in a binary tree, offsets of the slot otherwise), the
digests sent to those indices meet the nodes there in an equijoin, and the rows of slot zero, which
then hold the whole run, emit the parents. The joined siblings are also what the proofs consist of.

Leaves are numbered without putting a source in one task: rows are dealt by ranges of the order,
ranges are counted, the counts summed up, and a row is only ranked within its range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskwise.llm.common import held
from deskwise.llm.sharding import global_rank

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A row of the tree over the subroots has this for its tree.
TOP = ""
STEP = "struct<before:binary,after:binary>"


def record_digest(values: list[Column]) -> Column:
    """Hex SHA-256 of the values one after the other, each behind its length in bytes; a null is '-'."""
    parts = []
    for value in values:
        text = value.cast("string")
        parts.append(F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text), F.lit(":"), text)))
    return F.sha2(F.concat(*parts), 256)


def tampered(text: Column) -> Column:
    """The text with A-Z in lower case, as long as before."""
    return F.translate(text, UPPER, LOWER)


def tampers(doc_id: Column) -> Column:
    """Whether the row is one of those tampered with; a row without an id is not."""
    crc = F.crc32(F.encode(doc_id.cast("string"), "UTF-8"))
    return F.coalesce(crc % 5 == 0, F.lit(False))


def _hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _joined(siblings: Column, keep) -> Column:
    """The siblings that are kept, one after the other; they are sorted by slot."""
    kept = F.transform(F.filter(siblings, keep), lambda s: F.hex(s["digest"]))
    return F.unhex(F.array_join(kept, ""))


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Stored rows with idx, their place from 0 within their tree, and n, the rows of the tree."""
    stored = held(
        rows.withColumn("salt", F.monotonically_increasing_id())
        .repartitionByRange("tree", *order, "salt")
        .withColumn("cell", F.spark_partition_id()),
        "ranges",
    )
    ranked = global_rank(stored, ["tree"], "cell", [*order, "salt"], "rank")
    sizes = stored.groupBy("tree").agg(F.count("*").alias("n"))
    return ranked.join(sizes, "tree").withColumn("idx", F.col("rank") - 1).drop("rank", "salt")


def _sibling_indices(arity: int) -> Column:
    """Of each sibling of a node, as many as a whole run has."""
    if arity == 2:
        return F.array(F.col("idx").bitwiseXOR(F.lit(1).cast("long")))
    slot = F.col("idx") % arity
    return F.transform(
        F.sequence(F.lit(1), F.lit(arity - 1)), lambda shift: F.col("idx") - slot + (slot + shift) % arity
    )


def _with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Each node of the trees of more than one, with the digests of its run before and after it."""
    sent = nodes.select(
        "tree", "n",
        F.named_struct(F.lit("slot"), F.col("idx") % arity, F.lit("digest"), F.col("digest")).alias("sent"),
        F.explode(_sibling_indices(arity)).alias("idx"),
    ).where("idx < n").drop("n")
    kept = [c for c in nodes.columns if c not in ("tree", "idx")]
    met = nodes.select("tree", "idx", F.struct(*kept).alias("node")).join(sent, ["tree", "idx"], "left")
    runs = met.groupBy("tree", "idx").agg(
        F.first("node").alias("node"), F.sort_array(F.collect_list("sent")).alias("siblings")
    )
    slot = F.col("idx") % arity
    return runs.select(
        "tree", "idx", "node.*",
        _joined(F.col("siblings"), lambda s: s["slot"] < slot).alias("before"),
        _joined(F.col("siblings"), lambda s: s["slot"] > slot).alias("after"),
    )


def _climb(nodes: DataFrame, arity: int, purpose: str) -> tuple[list[DataFrame], list[DataFrame]]:
    """From numbered nodes: per level the nodes with their siblings, and the last nodes of the trees that
    have no more than one there. All are stored; a level has a sixteenth of the rows of the one below."""
    nodes = held(nodes, f"{purpose}-nodes")
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels, ended = [], [nodes.where("n = 1")]
    while most > 1:
        levels.append(held(_with_siblings(nodes.where("n > 1"), arity), f"{purpose}-level"))
        run = F.concat(_hex(F.col("before")), _hex(F.col("digest")), _hex(F.col("after")))
        nodes = levels[-1].where(F.col("idx") % arity == 0).select(
            "tree", F.expr(f"idx div {arity}").alias("idx"), F.unhex(F.sha2(run, 256)).alias("digest"),
            F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
        )
        ended.append(nodes.where("n = 1"))
        most = -(-most // arity)
    return levels, ended


def _last_nodes(ended: list[DataFrame]) -> DataFrame:
    last = ended[0].select("tree", "digest")
    for more in ended[1:]:
        last = last.unionByName(more.select("tree", "digest"))
    return last


def _descend(levels: list[DataFrame], ended: list[DataFrame], above: DataFrame, arity: int) -> DataFrame:
    """The nodes of the first level (digest, row) with their path and what else ``above`` hands down to
    the trees; paths grow from what ``above`` holds for the last node of each tree."""
    handed = [c for c in above.columns if c not in ("tree", "path")]
    paths = None
    for level in range(len(ended) - 1, -1, -1):
        own = ["digest", "row"] if level == 0 else []
        paths_here = ended[level].join(above, "tree").select("tree", "idx", "path", *own, *handed)
        if paths is not None:
            step = F.concat(F.array(F.struct("before", "after")), F.col("path"))
            inner = (
                levels[level].select("tree", "idx", "before", "after", *own, F.expr(f"idx div {arity}").alias("parent"))
                .join(paths.withColumnRenamed("idx", "parent"), ["tree", "parent"])
                .select("tree", "idx", step.alias("path"), *own, *handed)
            )
            paths_here = inner.unionByName(paths_here)
        paths = paths_here
    return paths


def manifest(rows: DataFrame, tree: str, order: list[str], leaf: str = "leaf", arity: int = ARITY) -> DataFrame:
    """The rows with subroot, root (hex) and path: per level, up to the subroot and on to the root, the
    digests of the node's run before it and behind it.

    ``leaf`` holds hex digests. A tree's leaves ascend by ``order``, nulls first, then by leaf; rows
    equal in these are interchangeable. A null tree is a tree of its own, before all others, and an
    empty one another. No rows give none. Columns of the caller that are called like a result give way.
    """
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in (leaf, "subroot", "root", "path")]
    keys = [f"key_{k}" for k in range(len(order))]
    leaves = rows.select(
        F.coalesce(F.concat(F.lit("v"), F.col(tree).cast("string")), F.lit("")).alias("tree"),
        *[F.col(c).alias(k) for c, k in zip(order, keys, strict=True)],
        F.unhex(F.col(leaf)).alias("digest"),
        F.struct(*kept).alias("row"),
    )
    # Read twice, for the bounds of the ranges and for the rows: stored, so that texts are read once.
    numbered = _numbered(held(leaves, "leaves"), [*keys, "digest"])
    levels, ended = _climb(numbered.select("tree", "idx", "n", "digest", "row"), arity, "leaf")

    subroots = _last_nodes(ended).select(F.lit(TOP).alias("tree"), F.col("tree").alias("of"), "digest")
    over = _numbered(held(subroots, "subroots"), ["of"])
    top_levels, top_ended = _climb(over.select("tree", "idx", "n", "digest", F.struct("of").alias("row")), arity, "top")
    root = _last_nodes(top_ended).select(_hex(F.col("digest"))).first()  # one row, none without rows
    empty = F.array().cast(f"array<{STEP}>")
    tops = _descend(top_levels, top_ended, top_ended[-1].select("tree", empty.alias("path")), arity)
    above = held(tops.select(F.col("row.of").alias("tree"), "path", F.col("digest").alias("subroot")), "subroot-paths")

    return _descend(levels, ended, above, arity).select(
        "row.*", _hex(F.col("digest")).alias(leaf), _hex(F.col("subroot")).alias("subroot"),
        F.lit(root[0] if root else None).cast("string").alias("root"), "path",
    )


def proof_digest(path: Column) -> Column:
    """Hex SHA-256 of all siblings on the way to the root, from left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(_hex(s["before"]), _hex(s["after"]))), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings of its path."""
    return F.aggregate(
        path, leaf, lambda node, s: F.sha2(F.concat(_hex(s["before"]), node, _hex(s["after"])), 256)
    )


def verified_documents(docs: DataFrame, arity: int = ARITY) -> DataFrame:
    """Documents in the manifest of their table, each proved against the root after a trial: where 5
    divides the CRC-32 of the doc_id, the text is lower-cased (A-Z) behind the manifest's back.

    Returns doc_id, leaf, subroot, root, path, folded_root and verified. A leaf digests doc_id, source,
    lang, n_chars and text, so a null differs from an empty text. Leaves ascend by doc_id within their
    source, rows without one first; rows that repeat a doc_id are leaves of their own, in the order of
    their digests. A tampered text without capitals is as before and verifies. No rows: none. Columns
    other than the five are neither read nor covered.
    """
    fields = {c: F.col(c) for c in FIELDS}
    lowered = {**fields, "text": tampered(fields["text"])}
    original = record_digest(list(fields.values()))
    rows = docs.select(
        "doc_id", "source", original.alias("leaf"),
        F.when(tampers(fields["doc_id"]), record_digest(list(lowered.values()))).alias("changed"),
    )
    proved = manifest(rows, "source", ["doc_id"], arity=arity)
    at_trial = F.coalesce("changed", "leaf")
    return proved.withColumn("folded_root", folded(at_trial, F.col("path"))).select(
        "doc_id", "leaf", "subroot", "root", "path", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
