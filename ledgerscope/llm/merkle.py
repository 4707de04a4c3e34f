"""Merkle dataset manifest with nested-interval labels.

Every node of a language's tree carries the interval of leaf ranks that it covers. A node at level k
covers the ranks from a multiple of 8^k on, so the ranks divided by 8^k are the buckets in which a join
by containment finds a node's ancestor at that level. What is left of the parent's interval without the
node's own is covered by its siblings: those that end where it begins or before, and those that begin
where it ends or after. From the top down each level takes its parents' path and puts its own siblings
in front, so a path is stored once for the eight leaves below it.

Leaves are ranked by a range shuffle and the places inside its partitions, not by a window over a
language: one language may hold most rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerscope.llm.common import cut

#: children of a node
FAN = 8
#: rows of a partition of the range shuffle: as many at most, and about as many at least if there are tasks to spare
MOST_ROWS, FEW_ROWS = 500_000, 20_000
#: languages that are broadcast at most (about 100 bytes each); beyond it their join is shuffled
BROADCAST_LANGS = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest_of(*values: Column) -> Column:
    """Lowercase hex SHA-256 of the values one after another: ``-`` for null, else byte count, colon, value."""
    said = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*said), 256)


def _positions(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``rows`` (materialised) with ``pos``: each row's place in the order, from 0."""
    spark = rows.sparkSession
    n = rows.count()
    tasks = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // FEW_ROWS))
    parts = max(1, tasks, -(-n // MOST_ROWS))
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = cut(ranged.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()))
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("part", (before - F.col("first")).alias("shift"))  # one row per partition
    return placed.join(F.broadcast(starts), "part").withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _whole() -> Column:
    return F.col("hi") - F.col("lo") == F.col("n")


def _levels(leaves: DataFrame, most: int, payload: Sequence[str] = ()) -> list[DataFrame]:
    """The parents of each level: ``g, n, lo, hi, run, digest``, ``run`` being the children in order.

    ``leaves`` are ``g, n, lo, hi, digest`` and the payload, which the lowest runs keep. ``n`` is the number of leaves of
    tree ``g`` and ``most`` the largest.
    """
    levels, children, level = [], leaves, 0
    while FAN**level < most:
        level += 1
        fields = ["lo", "hi", "digest", *(payload if level == 1 else ())]
        bucket = F.expr(f"lo div {FAN**level}L").alias("bucket")
        runs = children.where(~_whole()).groupBy("g", "n", bucket).agg(F.collect_list(F.struct(*fields)).alias("run"))
        run = F.array_sort("run", lambda a, b: F.when(a["lo"] < b["lo"], -1).otherwise(1))
        runs = runs.select("g", "n", run.alias("run"))
        children = cut(
            runs.select(
                "g", "n", F.element_at("run", 1)["lo"].alias("lo"), F.element_at("run", -1)["hi"].alias("hi"), "run",
                F.sha2(F.array_join("run.digest", ""), 256).alias("digest"),
            )
        )
        levels.append(children)
    return levels


def _siblings(run: Column, lo: Column, hi: Column) -> Column:
    """The digests of the parent's interval without the node's own, on either side of it."""

    def joined(keep):
        return F.array_join(F.transform(F.filter(run, keep), lambda x: x["digest"]), "")

    return F.struct(joined(lambda x: x["hi"] <= lo).alias("left"), joined(lambda x: x["lo"] >= hi).alias("right"))


def _attach(leaves: DataFrame, levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """The leaves' columns but the tree's, with those of ``above`` (``g, path, ..``): ``path`` grows by the tree's levels.

    ``path`` lists the siblings at each level from the leaf up; ``top`` is the digest of the tree's highest node.
    """
    own = [c for c in above.columns if c not in ("g", "path")]
    parents = None
    for level in range(len(levels), 0, -1):
        nodes = levels[level - 1]
        found = nodes.where(_whole()).join(above, "g").withColumn("top", F.col("digest"))
        if parents is not None:
            bucket = F.expr(f"lo div {FAN ** (level + 1)}L").alias("bucket")
            p = parents.select("g", bucket, *[F.col(c).alias(f"p_{c}") for c in ("lo", "hi", "run")], "path", "top", *own)
            inside = (F.col("lo") >= F.col("p_lo")) & (F.col("hi") <= F.col("p_hi"))
            below = nodes.where(~_whole()).withColumn("bucket", bucket).join(p, ["g", "bucket"]).where(inside)
            step = _siblings(F.col("p_run"), F.col("lo"), F.col("hi"))
            found = found.unionByName(below.withColumn("path", F.concat(F.array(step), F.col("path"))).select(found.columns))
        parents = found.select("g", "lo", "hi", "run", "path", "top", *own)
    plain = [c for c in leaves.columns if c not in ("g", "n")]
    alone = leaves.where("n = 1").join(above, "g").select(*plain, "path", F.col("digest").alias("top"), *own)
    if parents is None:
        return alone
    each = parents.select(F.explode("run").alias("x"), "run", "path", "top", *own)
    step = _siblings(F.col("run"), F.col("x.lo"), F.col("x.hi"))
    members = each.select(*[F.col(f"x.{c}").alias(c) for c in plain], F.concat(F.array(step), F.col("path")).alias("path"), "top", *own)
    return members.unionByName(alone)


def _ranked(docs: DataFrame, claimed: Column | None, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Leaves ``g, n, lo, hi, digest, doc_id, claimed``, and the trees ``g, lang, n``."""
    doc_id, source, lang, n_chars, text = [F.col(f"`{c}`") for c in columns]
    leaf = digest_of(doc_id, source, lang, n_chars, text)
    other = leaf if claimed is None else digest_of(doc_id, source, lang, n_chars, claimed)
    rows = docs.select(
        doc_id.cast("long").alias("doc_id"), lang.alias("lang"), leaf.alias("digest"), other.alias("claimed"), F.monotonically_increasing_id().alias("row")
    )
    order = [F.asc_nulls_first("lang"), F.asc_nulls_last("doc_id"), F.asc("digest"), F.asc("row")]
    placed = _positions(cut(rows), order)
    langs = cut(placed.groupBy("lang").agg(F.min("pos").alias("start"), F.count(F.lit(1)).alias("n")))
    trees = cut(_positions(langs, [F.asc_nulls_first("lang")]).withColumnRenamed("pos", "g"))
    bounded = trees.select(F.col("lang").alias("tree"), "start", "n", "g")
    bounded = F.broadcast(bounded) if trees.count() <= BROADCAST_LANGS else bounded
    joined = placed.join(bounded, F.col("lang").eqNullSafe(F.col("tree")))
    lo = F.col("pos") - F.col("start")
    return joined.select("g", "n", lo.alias("lo"), (lo + 1).alias("hi"), "digest", "doc_id", "claimed"), trees.select("g", "lang", "n")


COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PAYLOAD = ("doc_id", "claimed")


class Manifest:
    """The trees of a table: one per language, and one over their highest nodes in the order of languages.

    Within a language leaves ascend by id, null ids last, rows with one id by their digests; equal rows are
    leaves of their own. A null language is one of its own and comes first. ``claimed`` is a text that is to
    be verified in place of the row's own. An empty table has no nodes. Columns other than the five that
    make a leaf are ignored.
    """

    def __init__(self, docs: DataFrame, claimed: Column | None = None, columns: Sequence[str] = COLUMNS):
        spark = docs.sparkSession
        self.leaves, self.trees = _ranked(docs, claimed, columns)
        most = self.trees.agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("trees")).first()
        self.levels = _levels(self.leaves, most["n"] or 0, PAYLOAD)
        tops = [x.where(_whole()).select("g", "digest") for x in [self.leaves.where("n = 1"), *self.levels]]
        subroots = tops[0]
        for x in tops[1:]:
            subroots = subroots.unionByName(x)
        self.subroots = cut(
            subroots.select(F.lit(0).cast("long").alias("g"), F.lit(most["trees"]).cast("long").alias("n"), F.col("g").alias("lo"), (F.col("g") + 1).alias("hi"), "digest")
        )
        self.upper = _levels(self.subroots, most["trees"])
        top = (self.upper or [self.subroots])[-1].select("digest").first()
        self.root = top["digest"] if top else None
        self.start = spark.range(1).select(F.col("id").alias("g"), F.array().cast("array<struct<left: string, right: string>>").alias("path"))

    def nodes(self) -> DataFrame:
        """``lang, level, lo, hi, digest``: the nodes of the languages' trees; leaves are level 0."""
        out = self.leaves.select("g", F.lit(0).alias("level"), "lo", "hi", "digest")
        for level, nodes in enumerate(self.levels, 1):
            out = out.unionByName(nodes.select("g", F.lit(level).alias("level"), "lo", "hi", "digest"))
        return out.join(self.trees.select("g", "lang"), "g").select("lang", "level", "lo", "hi", "digest")

    def proofs(self) -> DataFrame:
        """``doc_id, leaf, claimed, subroot, root, path``: one row per row of the table."""
        over = _attach(self.subroots, self.upper, self.start)
        over = over.select(F.col("lo").alias("g"), "path", F.lit(self.root).alias("root"))
        found = _attach(self.leaves, self.levels, cut(over))
        return found.select("doc_id", F.col("digest").alias("leaf"), "claimed", F.col("top").alias("subroot"), "root", "path")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of a path give."""
    return F.aggregate(path, leaf, lambda x, at: F.sha2(F.concat(at["left"], x, at["right"]), 256))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda at: F.concat(at["left"], at["right"])), ""), 256)


def lowered(text: Column) -> Column:
    """The text with A-Z in lower case."""
    return F.translate(text, UPPER, LOWER)


def verify_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``: one row per row of ``docs``.

    Where 3 divides the crc32 of the decimal id the claimed text is the row's own in lower case (A-Z); a null id claims
    its own text, and null texts stay null. A row is verified if its claimed leaf folds to the root.
    """
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    claimed = F.when(F.coalesce(tampered, F.lit(False)), lowered(F.col("text"))).otherwise(F.col("text"))
    rows = Manifest(docs, claimed).proofs().withColumn("folded_root", fold(F.col("claimed"), F.col("path")))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
