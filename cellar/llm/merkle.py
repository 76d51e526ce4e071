"""Merkle manifest of a dataset: a persistent, path-copying hash tree.

Leaves are hashes of rows, in order of (source, doc_id); runs of ``FAN`` nodes become their
hash, level by level, first within a source, then over the sources. Positions are distributed
ordinals, so no source has to be in one task. Aligned blocks of ``BLOCK`` (a power of ``FAN``)
consecutive nodes of a source are built in one task each; their roots are the nodes of the next
tier, stored in the shared folder, and so on: three levels a tier, 4,096 times fewer rows.

A leaf that changes makes a version of the tree: within its block the ancestors are copied and
every other node is shared (``Tree``). Above the block the version goes on along the block's
path, the siblings of its ancestors in the upper tiers, which comes to the block as one row:
upper versions are spread like the leaves, and no group ever holds more than a block.

Rows: null values and empty texts are told apart in the leaf's hash. A null ``source`` is a
source of its own and comes first; null ``doc_id`` come first within their source and count as
not tampered with. Repeated ids are ordered by their leaf's hash; repeated rows are leaves of
their own, with proofs of their own. An empty table has no rows. Other columns are not looked at.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellar.llm.common import crc32_mod, cut
from cellar.operators.ordinal import small_side, stable_partitions, with_ordinals

FAN = 16
BLOCK = FAN ** 3
_DIGEST = 64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _hash(text: str) -> str:
    return sha256(text.encode("ascii")).hexdigest()


class Tree:
    """Nodes of a block: digests and children by number, never changed once made."""

    def __init__(self, leaves: list[str], levels: int | None, fan: int = FAN):
        """``levels``: so many levels of runs, else (None) until one node remains."""
        self.fan = fan
        self.digests: list[str] = list(leaves)
        self.children: list[tuple[int, ...]] = [()] * len(leaves)
        self.levels = [list(range(len(leaves)))]
        while len(self.levels[-1]) > 1 if levels is None else len(self.levels) <= levels:
            below = self.levels[-1]
            self.levels.append([self._node(tuple(below[i:i + fan])) for i in range(0, len(below), fan)])

    def _node(self, children: tuple[int, ...]) -> int:
        self.digests.append(_hash("".join([self.digests[c] for c in children])))
        self.children.append(children)
        return len(self.digests) - 1

    @property
    def root(self) -> str:
        return self.digests[self.levels[-1][0]]

    def path(self, leaf: int) -> list[tuple[str, str]]:
        """Digests left and right of the leaf and its ancestors, level by level."""
        out = []
        for level in range(len(self.levels) - 1):
            leaf, slot = divmod(leaf, self.fan)
            run = self.children[self.levels[level + 1][leaf]]
            out.append(("".join([self.digests[c] for c in run[:slot]]), "".join([self.digests[c] for c in run[slot + 1:]])))
        return out

    def version(self, leaf: int, digest: str) -> list[int]:
        """Copy the path of a changed leaf: the new nodes from the leaf to the root of the version."""
        self.digests.append(digest)
        self.children.append(())
        made = [len(self.digests) - 1]
        for level in range(1, len(self.levels)):
            leaf, slot = divmod(leaf, self.fan)
            run = self.children[self.levels[level][leaf]]
            made.append(self._node(run[:slot] + (made[-1],) + run[slot + 1:]))
        return made


def _levels(size: int, block: int, fan: int) -> int | None:
    """Levels of a block: all of them when there are more blocks beside it."""
    if size <= block:
        return None
    levels = 0
    while fan ** levels < block:
        levels += 1
    return levels


def _blocks(nodes: DataFrame, block: int) -> DataFrame:
    return nodes.withColumn("block", (F.col("n") / F.lit(block)).cast("long"))


def _tiers(nodes: DataFrame, block: int, fan: int) -> tuple[list[DataFrame], DataFrame]:
    """``nodes`` (key, n, digest): the tiers with their nodes' number per key, and (key, digest) of the roots."""

    def roots(key, rows):
        rows = rows.sort_by("n")
        tree = Tree(rows.column("digest").to_pylist(), _levels(rows.column("size")[0].as_py(), block, fan), fan)
        return pa.table({"key": [key[0].as_py()], "n": [key[1].as_py()], "digest": [tree.root]})

    tiers = []
    while True:
        sizes = small_side(nodes.groupBy("key").agg(F.count(F.lit(1)).alias("size")))
        tiers.append(nodes.join(sizes, "key"))
        nodes = cut(_blocks(tiers[-1], block).groupBy("key", "block").applyInArrow(
            roots, "key string, n long, digest string"))
        if not nodes.where("n > 0").limit(1).count():
            return tiers, nodes.select("key", "digest")


_PATH = "array<struct<left: string, right: string>>"


def _paths(tiers: list[DataFrame], block: int, fan: int) -> DataFrame:
    """(key, n, path) of the nodes of the lowest of ``tiers``: their siblings up to the key's root."""

    def own(key, rows):
        rows = rows.sort_by("n")
        tree = Tree(rows.column("digest").to_pylist(), _levels(rows.column("size")[0].as_py(), block, fan), fan)
        path = [[{"left": a, "right": b} for a, b in tree.path(i)] for i in range(rows.num_rows)]
        return pa.table({"key": rows.column("key"), "n": rows.column("n"), "path": pa.array(
            path, pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())])))})

    found = None
    for tier in reversed(tiers):
        here = _blocks(tier, block).groupBy("key", "block").applyInArrow(own, f"key string, n long, path {_PATH}")
        if found is not None:
            above = found.select("key", F.col("n").alias("block"), F.col("path").alias("above"))
            here = _blocks(here, block).join(above, ["key", "block"]).select("key", "n", F.concat("path", "above").alias("path"))
        found = here
    return found


def leaf_hash(columns: list[Column]) -> Column:
    """Hash of a row: ``-`` for null, else the value's UTF-8 length, a colon and the value."""
    text = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.when(c.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)) for c in text]).cast("binary"), 256)


def lowered(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def manifest(docs: DataFrame, changed: Column, values: list[Column], forged: list[Column], doc_id: str = "doc_id",
             source: str = "source", proofs: bool = False, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) per row.

    ``values``: the columns that a leaf hashes; ``forged``: the same, as they are where ``changed``.
    ``proofs`` adds ``proof`` (siblings left and right, level by level, leaf to root) and
    ``copied`` (digests of the nodes that the row's version copies or makes, leaf to root).
    """
    key = F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit(""))
    rows = cut(docs.select(key.alias("key"), F.col(doc_id).cast("long").alias("doc_id"), leaf_hash(values).alias("digest"),
                           F.when(changed, leaf_hash(forged)).alias("forged")))
    leaves = cut(with_ordinals(stable_partitions(rows, ["doc_id", "digest"], group="key"), "n", group="key"))
    tiers, subroots = _tiers(leaves.select("key", "n", "digest"), block, fan)
    upper = _paths(tiers[1:], block, fan) if tiers[1:] else subroots.select(
        "key", F.lit(0).cast("long").alias("n"), F.array().cast(_PATH).alias("path"))
    # the tree over the sources
    order = with_ordinals(stable_partitions(subroots, ["key"]), "n").withColumnRenamed("key", "name")
    top = cut(order.select("name", F.lit("").alias("key"), "n", "digest"))
    top_tiers, root = _tiers(top.select("key", "n", "digest"), block, fan)
    subroot = (top.join(_paths(top_tiers, block, fan).select("n", "path"), "n").crossJoin(F.broadcast(root.select(
        F.col("digest").alias("root")))).select(F.col("name").alias("key"), F.col("digest").alias("subroot"),
                                                F.col("path").alias("above"), "root"))
    sides = cut(upper.withColumnRenamed("n", "block").join(small_side(cut(subroot)), "key").select(
        "key", "block", F.concat("path", "above").alias("path"), "subroot", "root"))
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if proofs:
        names += ["proof", "copied"]
        schema += f", proof {_PATH}, copied array<string>"

    def run(_, nodes, side):
        if not nodes.num_rows:
            return pa.Table.from_pylist([], pa.schema([(n, pa.null()) for n in names]))
        nodes = nodes.sort_by("n")
        leaf = nodes.column("digest").to_pylist()
        tree = Tree(leaf, _levels(nodes.column("size")[0].as_py(), block, fan), fan)
        above = [(p["left"], p["right"]) for p in side.column("path")[0].as_py()]
        rest = "".join([a + b for a, b in above])
        root_ = side.column("root")[0].as_py()
        folded, proof, copied, paths = [], [], [], []
        for i, new in enumerate(nodes.column("forged").to_pylist()):
            path = tree.path(i)
            proof.append(_hash("".join([a + b for a, b in path]) + rest))
            if new is None:
                # the version is the tree itself: its block's root goes up the same way
                made = []
                digest = leaf[i]
                for a, b in path:
                    digest = _hash(a + digest + b)
            else:
                made = [tree.digests[j] for j in tree.version(i, new)]
                digest = made[-1]
            for a, b in above:
                digest = _hash(a + digest + b)
                if made:
                    made.append(digest)
            folded.append(digest)
            if proofs:
                copied.append(made)
                paths.append([{"left": a, "right": b} for a, b in path + above])
        out = {"doc_id": nodes.column("doc_id"), "leaf": leaf,
               "subroot": [side.column("subroot")[0].as_py()] * len(leaf), "root": [root_] * len(leaf),
               "proof_sha256": proof, "folded_root": folded, "verified": [f == root_ for f in folded]}
        if proofs:
            out |= {"proof": pa.array(paths, pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))),
                    "copied": pa.array(copied, pa.list_(pa.string()))}
        return pa.table(out)

    # positions and hashes again, with the forged ones; a block and its path meet in one task
    sized = leaves.join(small_side(leaves.groupBy("key").agg(F.count(F.lit(1)).alias("size"))), "key")
    return _blocks(sized, block).groupBy("key", "block").cogroup(sides.groupBy("key", "block")).applyInArrow(run, schema)


def digest(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    values = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars")]
    changed = F.col("doc_id").isNotNull() & (crc32_mod("doc_id", 5) == 0)
    return manifest(docs, changed, [*values, text], [*values, lowered(text)])


# ---------------------------------------------------------------- the same in DuckDB


def _oracle(levels: int = 6) -> str:
    """Levels of either tree are unrolled: enough for 16**levels leaves of a source, and so many sources."""

    def value(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(value(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    bit = "CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    parts = [f"""
  crc(doc_id, rest, c, k) AS (
    SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR), CAST(4294967295 AS BIGINT), 0 FROM documents WHERE doc_id IS NOT NULL
    UNION ALL
    SELECT doc_id, CASE WHEN k % 9 = 0 THEN rest[2:] ELSE rest END,
           CASE WHEN k % 9 = 0 THEN xor(c, CAST(ascii(rest[1]) AS BIGINT)) ELSE {bit} END, k + 1
    FROM crc WHERE k % 9 > 0 OR len(rest) > 0
  )""", f"""
  doc AS (
    SELECT d.doc_id, d.source, {leaf('d.text').replace('doc_id', 'd.doc_id', 2)} AS leaf,
           CASE WHEN x.c % 5 = 0 THEN {leaf(f"translate(d.text, '{_UPPER}', '{_LOWER}')").replace('doc_id', 'd.doc_id', 2)} END AS forged
    FROM documents d LEFT JOIN (
      SELECT doc_id, xor(arg_max(c, k), 4294967295) AS c FROM crc GROUP BY doc_id) x USING (doc_id)
  )""", """
  pos AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM doc
  )""", "s0 AS (SELECT source, p AS n, leaf AS d FROM pos)"]

    def tree(t: str, key: str) -> None:
        for i in range(levels):
            run = f"PARTITION BY {key}, n // 16 ORDER BY n ROWS BETWEEN"
            parts.append(f"""
  {t}{i}x AS (
    SELECT *, count(*) OVER (PARTITION BY {key}) AS size,
           coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
           coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b FROM {t}{i}
  )""")
            parts.append(f"""
  {t}{i + 1} AS (
    SELECT {key}, CASE WHEN any_value(size) > 1 THEN n // 16 ELSE 0 END AS n,
           CASE WHEN any_value(size) > 1 THEN sha256(string_agg(d, '' ORDER BY n)) ELSE any_value(d) END AS d
    FROM {t}{i}x GROUP BY {key}, n // 16
  )""")

    tree("s", "source")
    parts.append(f"""
  sub AS (SELECT source, d, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS q FROM s{levels})""")
    parts.append("t0 AS (SELECT 0 AS one, q AS n, d FROM sub)")
    tree("t", "one")
    joins, before, fold = [], [], "coalesce(pos.forged, pos.leaf)"
    steps = []
    for t, at, match in (("s", "pos.p", "source IS NOT DISTINCT FROM pos.source"), ("t", "sub.q", "one = 0")):
        for i in range(levels):
            x = f"{t}{i}x"
            joins.append(f"JOIN {x} ON {x}.{match} AND {x}.n = {at} // {16 ** i}")
            before.append(f"CASE WHEN {x}.size > 1 THEN {x}.a || {x}.b ELSE '' END")
            steps.append(x)
    side = ", ".join(f"{x}.size AS {x}_n, {x}.a AS {x}_a, {x}.b AS {x}_b" for x in steps)
    parts.append(f"""
  flat AS (
    SELECT pos.doc_id, pos.leaf, sub.d AS subroot, (SELECT d FROM t{levels}) AS root,
           sha256({' || '.join(before)}) AS proof_sha256, {fold} AS f0, {side}
    FROM pos JOIN sub ON sub.source IS NOT DISTINCT FROM pos.source {' '.join(joins)}
  )""")
    for i, x in enumerate(steps):
        parts.append(f"""
  f{i + 1} AS (
    SELECT * EXCLUDE (f0), CASE WHEN {x}_n > 1 THEN sha256({x}_a || f0 || {x}_b) ELSE f0 END AS f0
    FROM {'flat' if i == 0 else f'f{i}'}
  )""")
    return (f"WITH RECURSIVE {', '.join(parts)}\nSELECT doc_id, leaf, subroot, root, proof_sha256, f0 AS folded_root, "
            f"f0 = root AS verified FROM f{len(steps)}")


#: The same over whole tables in DuckDB.
ORACLE_SQL = _oracle()
