"""Merkle manifest of a dataset: a tree of digests per source, a tree over the sources, and
a proof for every row, checked by a recursive query.

Leaves are sorted by a range shuffle of digests and numbered from partition totals, so no
task takes a whole source.  A tree is built ``LEVELS`` levels at a time: ``FAN ** LEVELS``
neighbouring nodes are one group, and each of its nodes is stored as a row with the link to
its ancestor ``LEVELS`` levels up and the siblings met on the way.  The recursive query then
ascends from every leaf along these links, appending siblings and folding the leaf's digest;
a step takes one stored row, so it shuffles a leaf's state once per ``LEVELS`` levels instead
of once per level.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path
from .common import numbered, written_at

FAN = 3
LEVELS = 6
BLOCK = FAN ** LEVELS
LINK = ["parent", "parent_salts", "digest", "top", "path"]
SALTS = 32          # copies of a stored node with more than BLOCK leaves, so that no join key is hot


def field(value: Column) -> Column:
    """``-`` for null, else byte count, ``:``, value (binary)."""
    raw = value.cast("string").cast("binary")
    sized = F.concat(F.octet_length(raw).cast("string").cast("binary"), F.lit(b":"), raw)
    return F.coalesce(sized, F.lit(b"-"))


def leaf_digest(columns: list[Column]) -> Column:
    """SHA-256 (32 bytes) of a row's fields, one after the other."""
    return F.unhex(F.sha2(F.concat(*(field(c) for c in columns)), 256))


def _hex(raw: str) -> str:
    return f"lower(hex({raw}))"


def _parent(raw: str) -> str:
    """Digest of nodes whose raw digests stand one after the other: over their hex text."""
    return f"unhex(sha2({_hex(raw)}, 256))"


def _levels(depth: str) -> str:
    """All levels of a group, from ``nodes`` (array of raw digests) up ``depth`` levels."""
    runs = f"sequence(0, cast(ceil(size(last) / {FAN}) as int) - 1)"
    joined = " || ".join(f"coalesce(get(last, {FAN} * i + {k}), X'')" for k in range(FAN))
    above = (f"transform(array(element_at(tree, -1)), last -> transform({runs}, "
             f"i -> {_parent(joined)}))")
    return (f"aggregate(if({depth} > 0, sequence(1, {depth}), array()), array(nodes), "
            f"(tree, k) -> concat(tree, {above}))")


def _path(place: str, depth: str) -> str:
    """Per level the siblings' raw digests before and after the node on the way up."""
    at = f"cast(floor({place} / pow({FAN}, k)) as int)"
    # v: the level's nodes, the node's number, and its place in its run
    before = " || ".join(f"if(v.at % {FAN} > {k}, coalesce(get(v.level, v.at - v.at % {FAN} + {k}), "
                         "X''), X'')" for k in range(FAN - 1))
    after = " || ".join(f"if(v.at % {FAN} < {k}, coalesce(get(v.level, v.at - v.at % {FAN} + {k}), "
                        "X''), X'')" for k in range(1, FAN))
    return (f"transform(if({depth} > 0, sequence(0, {depth} - 1), array()), k -> element_at("
            f"transform(array(named_struct('level', tree[k], 'at', {at})), "
            f"v -> named_struct('before', {before}, 'after', {after})), 1))")


def _fold(path: str, digest: str) -> str:
    """The digest reached from ``digest`` along the stored siblings."""
    return (f"aggregate({path}, {digest}, (d, s) -> "
            f"{_parent('s.before || d || s.after')})")


def _siblings(path: str) -> str:
    """The raw digests of a path's siblings, level by level, left to right."""
    return f"aggregate({path}, X'', (b, s) -> b || s.before || s.after)"


def _name(tree: int, grp, step: int, place) -> Column:
    """A stored node's name: its tree, group, step above the leaves and place there."""
    return F.struct(F.lit(tree).alias("tree"), grp.alias("grp"), F.lit(step).alias("step"),
                    place.cast("long").alias("place"))


def _step(nodes: DataFrame, payload: list[str], tree: int, step: int) -> DataFrame:
    """Rows of one step of the trees of ``nodes`` (``grp, place, total, digest``, payload).

    ``path`` leads to the ancestor ``parent`` with the digest ``top``.  The top of a
    source's tree leads on to the source's node in the tree of sources, whose top to nowhere.
    """
    lone = f"size(filter(sequence(0, {LEVELS - 1}), k -> pow({FAN}, k) < total))"
    blocks = nodes.groupBy("grp", "total", F.floor(F.col("place") / BLOCK).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("place", "digest", *payload))).alias("members"))
    trees = (blocks.withColumn("depth", F.expr(f"if(total > {BLOCK}, {LEVELS}, {lone})"))
             .withColumn("nodes", F.expr("transform(members, m -> m.digest)"))
             .withColumn("tree", F.expr(_levels("depth"))))
    rows = trees.select("grp", "total", "block", "depth", "tree", F.inline("members"))
    last = F.col("total") <= BLOCK
    beyond = _name(1, F.col("grp"), 0, F.lit(0)) if tree == 0 else F.lit(None)
    # A parent with more than BLOCK leaves is stored in SALTS copies.
    many = F.lit(SALTS if tree or step else 1)
    return rows.select(
        F.when(last, beyond).otherwise(_name(tree, F.col("grp"), step + 1, F.col("block")))
        .alias("parent"), many.alias("parent_salts"), "grp", "place", "total", "digest", *payload,
        F.element_at(F.element_at("tree", -1), 1).alias("top"),
        F.expr(_path(f"cast(place - block * {BLOCK} as int)", "depth")).alias("path"))


def _grow(nodes: DataFrame, payload: list[str], tree: int, path: str) -> tuple[list, DataFrame]:
    """Store all steps of the trees of ``nodes``: tables by step, and every tree's top
    (``grp, digest, salts``: in how many copies the node above is stored)."""
    steps: list[DataFrame] = []
    ends: DataFrame | None = None
    while True:
        rows = written_at(_step(nodes, payload if not steps else [], tree, len(steps)),
                      f"{path}/tree{tree}-step{len(steps)}")
        tops = rows.where(F.col("place") % BLOCK == 0)
        done = tops.where(F.col("total") <= BLOCK).select(
            "grp", F.col("top").alias("digest"), F.col("parent_salts").alias("salts"))
        ends = done if ends is None else ends.unionByName(done)
        steps.append(rows)
        nodes = tops.where(F.col("total") > BLOCK).select(
            "grp", F.floor(F.col("place") / BLOCK).alias("place"),
            F.ceil(F.col("total") / BLOCK).alias("total"), F.col("top").alias("digest"))
        if nodes.isEmpty():
            return steps, ends


def build(docs: DataFrame, fields: list[str], path: str, doc_id: str = "doc_id",
          source: str = "source", claim: list[Column] | None = None) -> None:
    """Store the manifest of ``docs`` at ``path``: ``leaves`` and ``higher`` nodes.

    A row's leaf is the digest of its ``fields`` (null and empty differ).  In a source,
    leaves ascend by id (nulls first; rows with one id by digest, so repeated rows are
    leaves of their own).  A null source is a source of its own and comes first.  ``claim``
    are the fields of a copy to be checked in the row's place (else the row itself).  An
    empty table stores no nodes.  Texts of any length are hashed whole where they are
    read and never shuffled; other columns are ignored.
    """
    own = leaf_digest([docs[c] for c in fields])
    rows = written_at(docs.select(
        docs[doc_id].alias("doc_id"), docs[source].cast("string").alias("source"),
        own.alias("digest"), leaf_digest(claim).alias("claim") if claim else own.alias("claim"),
        field(docs[source]).cast("string").alias("grp")), f"{path}/rows")
    placed = numbered(rows, "grp", ["source", "doc_id", "digest", "claim"], f"{path}/sorted")
    steps, subroots = _grow(placed, ["doc_id", "claim"], 0, path)
    sources = rows.select("grp", "source").distinct().join(subroots, "grp").select(
        F.lit("all").alias("all"), "grp", "source", "digest", "salts")
    ranked = numbered(sources, "all", ["all", "source"], f"{path}/sources")
    above, _ = _grow(ranked.select(F.col("all").alias("grp"), "place", "total", "digest",
                                   F.col("grp").alias("of"), "salts"), ["of", "salts"], 1, path)
    higher = [t.select(_name(0, F.col("grp"), k, F.col("place")).alias("node"), F.lit(
        1 if k == 1 else SALTS).alias("salts"), *LINK) for k, t in enumerate(steps) if k]
    higher += [t.select(_name(1, F.col("grp" if k else "of"), k, F.col("place") if k else F.lit(0))
                        .alias("node"), F.lit(SALTS).alias("salts") if k else F.col("salts"), *LINK)
               for k, t in enumerate(above)]
    reduce(DataFrame.unionByName, higher).withColumn("salt", F.explode(
        F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts").write.parquet(f"{path}/higher")
    steps[0].select("doc_id", F.col("place").alias("lane"), "claim", *LINK).write.parquet(
        f"{path}/leaves")


CLIMB = f"""
WITH RECURSIVE climb(doc_id, lane, leaf, folded, siblings, parent, salt, subroot, root) AS (
  SELECT doc_id, lane, digest, {_fold('path', 'claim')}, {_siblings('path')}, parent,
         cast(pmod(lane, parent_salts) AS int), cast(NULL AS binary), top
  FROM {{leaves}}
  UNION ALL
  SELECT c.doc_id, c.lane, c.leaf, {_fold('n.path', 'c.folded')},
         c.siblings || {_siblings('n.path')}, n.parent,
         cast(pmod(c.lane, n.parent_salts) AS int),
         CASE WHEN n.node.tree = 1 THEN coalesce(c.subroot, n.digest) END, n.top
  FROM climb c JOIN {{higher}} n ON c.parent = n.node AND c.salt = n.salt)
SELECT doc_id, leaf, subroot, root, siblings, folded AS folded_root, folded = root AS verified
FROM climb WHERE parent IS NULL"""
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def prove(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, leaf, subroot, root, siblings, folded_root, verified`` of a stored manifest.

    One row per leaf; digests are 32 bytes, ``siblings`` all of the leaf's, one after the
    other from its own run up to the root.  ``folded_root`` is reached from the leaf's claim
    along its stored siblings, and ``verified`` says whether it is the root.  The
    recursive query runs here, with no limit on its rows, and its rows are written to the
    shared folder.
    """
    limit = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        return written_at(spark.sql(CLIMB, leaves=spark.read.parquet(f"{path}/leaves"),
                                higher=spark.read.parquet(f"{path}/higher")),
                      fresh_path(spark, "proofs"))
    finally:
        spark.conf.set(ROW_LIMIT, limit)
