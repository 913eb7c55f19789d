"""Merkle manifest of a table: a digest of each row, a tree over the rows of each language, a tree over these, and proofs by pointer jumping.

Leaves are ranged by language and id and numbered there, so that a large language is spread over tasks. Subtrees of
2 ** STEPS leaves are built a task each, so that a tree of any size takes a few rounds. Every node keeps the token of its sibling: L or R,
for the side where it stands, and its digest, or - where there is none. Proofs come by pointer jumping: each node holds the tokens towards an ancestor; a self-join
with that ancestor doubles the distance and appends its tokens, until the leaves reach the root. Only nodes on levels that are
multiples of the distance are still pointed at, so the other side of the joins shrinks with the square of the distance.

Defined results: a null field is `-`, so that null and empty texts have different leaves; rows of one id are ordered by their leaves and
repeated rows are leaves of their own; a null id comes first, and a null language before the others; a language of one row has its leaf as
its subroot and takes no tokens there; other columns, whatever their names, are carried; a very long text is digested as a whole; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.tables import BROADCAST_ROWS, documents, small, written

#: Levels that one task builds of a subtree.
STEPS = 10
NODES = "tree string, level int, idx long, token string, digest string, n long"


def row_digest(*fields: Column) -> Column:
    """sha256 of the fields, each as its byte count, a colon and its text; - for null."""

    def framed(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(framed, fields)).cast("binary"), 256)


def _numbered(leaves: DataFrame, order: list[str]) -> DataFrame:
    """`leaves` (tree, digest, ...) with idx, their place in the tree by `order` from 0, and n, the leaves of the tree."""
    cols = ["tree", *order]
    # Repeated rows agree in all columns of the order; the task that read them spreads them.
    ranged = leaves.withColumn("salt", F.spark_partition_id()).repartitionByRange(*cols, "salt").sortWithinPartitions(*cols).drop("salt")
    placed = written(ranged.withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}), "placed-leaves")
    runs = placed.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("rows"), F.min("place").alias("first"))
    each = Window.partitionBy("tree").orderBy("part")  # a row a task that holds some of the tree
    before = F.coalesce(F.sum("rows").over(each.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(F.col("tree").alias("r_tree"), F.col("part").alias("r_part"), (before - F.col("first")).alias("shift"), F.sum("rows").over(Window.partitionBy("tree")).alias("n"))
    out = placed.join(small(written(runs, "runs")), F.col("tree").eqNullSafe(F.col("r_tree")) & (F.col("part") == F.col("r_part")))
    return out.withColumn("idx", F.col("place") + F.col("shift")).drop("r_tree", "r_part", "shift", "place", "part")


def _climb(level: int):
    """Builds STEPS levels over one group of aligned nodes, or as many as lead to the root."""

    def climb(group: pa.Table) -> pa.Table:
        group = group.sort_by("idx")
        tree, n, at = group["tree"][0].as_py(), group["n"][0].as_py(), group["idx"][0].as_py()
        row, out = group["digest"].to_pylist(), []
        steps = STEPS if n > 1 << STEPS else (n - 1).bit_length()
        for k in range(steps):
            for i, digest in enumerate(row):
                token = "-" if i ^ 1 >= len(row) else ("L" if i & 1 else "R") + row[i ^ 1]
                out.append((level + k, at + i, token, digest))
            row = [hashlib.sha256("".join(row[i : i + 2]).encode()).hexdigest() for i in range(0, len(row), 2)]
            at >>= 1
        out.append((level + steps, at, None, row[0]))
        levels, places, tokens, digests = zip(*out)
        left = -(-n >> steps)
        return pa.table({
            "tree": pa.array([tree] * len(out), pa.string()), "level": pa.array(levels, pa.int32()), "idx": pa.array(places, pa.int64()),
            "token": pa.array(tokens, pa.string()), "digest": pa.array(digests, pa.string()), "n": pa.array([left] * len(out), pa.int64()),
        })

    return climb


def build(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All nodes below the roots, as (tree, level, idx, token), and the roots, as (tree, digest), of numbered leaves."""
    nodes, level, below, roots = leaves.select("tree", "idx", "digest", "n"), 0, None, None
    while True:
        grouped = nodes.withColumn("g", F.shiftright("idx", STEPS)).groupBy("tree", "g")
        out = written(grouped.applyInArrow(_climb(level), NODES), "tree-nodes")
        tops, rest = out.filter("token is null"), out.filter("token is not null").select("tree", "level", "idx", "token")
        done = tops.filter("n = 1").select("tree", "digest")
        below, roots = (rest, done) if below is None else (below.union(rest), roots.union(done))
        nodes, level = tops.filter("n > 1").select("tree", "idx", "digest", "n"), level + STEPS
        if nodes.isEmpty():
            return below, roots


def paths(leaves: DataFrame, below: DataFrame) -> DataFrame:
    """The leaves (tree, idx, row) with `path`, their tokens from the lowest up to the root, by pointer jumping."""
    on_level = dict(below.groupBy("level").agg(F.count(F.lit(1))).collect())  # a row a level
    first = below.filter("level = 0").select(F.col("tree").alias("l_tree"), F.col("idx").alias("l_idx"), "token")
    bottom = leaves.join(first, F.col("tree").eqNullSafe(F.col("l_tree")) & (F.col("idx") == F.col("l_idx")), "left")
    row = leaves.schema["row"].dataType
    nodes = bottom.select("tree", F.lit(0).alias("level"), "idx", "row", F.coalesce("token", F.lit("")).alias("path"))
    nodes = nodes.union(below.filter("level > 0").select("tree", "level", "idx", F.lit(None).cast(row), "token"))
    span = 1
    nodes = written(nodes, "tokens")
    while span < len(on_level):
        near = nodes.filter(F.col("level") % (2 * span) == 0)
        far = nodes.filter(F.col("level") % (2 * span) == span).select(F.col("tree").alias("f_tree"), F.col("level").alias("f_level"), F.col("idx").alias("f_idx"), F.col("path").alias("f_path"))
        to = F.col("tree").eqNullSafe(F.col("f_tree")) & (F.col("level") + span == F.col("f_level")) & (F.shiftright("idx", span) == F.col("f_idx"))
        few = sum(n for level, n in on_level.items() if level % (2 * span) == span) <= BROADCAST_ROWS
        joined = near.join(F.broadcast(far) if few else far, to, "left").select("tree", "level", "idx", "row", F.concat("path", F.coalesce("f_path", F.lit(""))).alias("path"))
        nodes, span = written(joined, "paths"), 2 * span
    return nodes.filter("level = 0").select("tree", "idx", "row", "path")


def proved(leaves: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(tree, row, path) of the leaves (tree, digest, row, and what orders them), and the roots (tree, digest)."""
    placed = _numbered(leaves, order)
    below, roots = build(placed)
    return paths(placed.select("tree", "idx", "row"), below), roots


def manifest(rows: DataFrame, group: str, key: str, leaf: str) -> DataFrame:
    """`rows` with subroot, root and proof: the digests of the trees, and the tokens from the row's leaf up to the root.

    Leaves of a group are ordered by `key`, groups by their name; see `folded` and `proof_digest` for what a proof is good for.
    """
    leaves = rows.select(F.col(group).cast("string").alias("tree"), F.col(key).alias("key"), F.col(leaf).alias("digest"), F.struct(*[rows[c] for c in rows.columns]).alias("row"))
    lower, subroots = proved(leaves, ["key", "digest"])
    tops = subroots.select(F.lit(None).cast("string").alias("tree"), F.col("tree").alias("name"), "digest", F.struct("tree", "digest").alias("row"))
    upper, root = proved(tops, ["name"])
    upper = written(upper.crossJoin(F.broadcast(root.select(F.col("digest").alias("root")))), "subroots")  # there is one root
    upper = upper.select(F.col("row.tree").alias("u_tree"), F.col("row.digest").alias("subroot"), F.col("path").alias("u_path"), "root")
    out = lower.join(small(upper), F.col("tree").eqNullSafe(F.col("u_tree")))
    return out.select("row.*", "subroot", "root", F.concat("path", "u_path").alias("proof"))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of a proof lead to."""
    tokens = F.regexp_extract_all(proof, F.lit("-|[LR][0-9a-f]{64}"), F.lit(0))
    side, sibling = lambda t: F.substring(t, 1, 1), lambda t: F.substring(t, 2, 64)
    both = lambda d, t: F.when(side(t) == "L", F.concat(sibling(t), d)).when(side(t) == "R", F.concat(d, sibling(t))).otherwise(d)
    return F.aggregate(tokens, leaf, lambda d, t: F.sha2(both(d, t).cast("binary"), 256))


def proof_digest(proof: Column) -> Column:
    """sha256 of the siblings' digests, from the leaf up."""
    return F.sha2(F.translate(proof, "LR-", "").cast("binary"), 256)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    leaf = lambda n: row_digest(F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text"))
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False)) & F.col("n_chars").isNotNull()
    rows = docs.select("doc_id", "lang", leaf(F.col("n_chars")).alias("leaf"), F.when(tampered, leaf(more)).alias("claimed"))
    out = manifest(rows, "lang", "doc_id", "leaf").withColumn("folded_root", folded(F.coalesce("claimed", "leaf"), F.col("proof")))
    return out.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


_NEXT_BYTE = "(case when j % 8 = 0 then xor(c, ascii(substr(doc_id::varchar, (j // 8 + 1)::int, 1))) else c end)"
#: CRC-32 of the digits of doc_id, bit by bit.
_CRC = f"xor(4294967295, list_reduce(list_transform(range(8 * length(doc_id::varchar)), lambda j: j::bigint), lambda c, j: xor({_NEXT_BYTE} >> 1, 3988292384 * ({_NEXT_BYTE} & 1)), 4294967295::bigint))"


def _leaf(n_chars: str) -> str:
    fields = (f"coalesce(strlen(({c})::varchar) || ':' || ({c})::varchar, '-')" for c in ("doc_id", "source", "lang", n_chars, "text"))
    return f"sha256({' || '.join(fields)})"


def _step(at: str, nodes: str, same: str) -> str:
    """A recursive term that takes each row of `at` one level up in the tree of `nodes`."""
    return f"""select {at}.doc_id, {at}.tree, {at}.leaf, {at}.idx // 2, {at}.level + 1, ({at}.n + 1) // 2,
        case when s.h is null then sha256({at}.h) when {at}.idx % 2 = 0 then sha256({at}.h || s.h) else sha256(s.h || {at}.h) end, {at}.sibs || coalesce(s.h, '')
    from {at} left join {nodes} s on {same} s.level = {at}.level and s.idx = xor({at}.idx, 1) where {at}.n > 1"""


OP12_SQL = f"""
with recursive d as (select doc_id, coalesce('=' || lang, '') as tree, {_leaf("n_chars")} as leaf, case when {_CRC} % 7 = 0 then {_leaf("n_chars + 1")} end as claimed from documents),
p as (select *, row_number() over (partition by tree order by doc_id, leaf) - 1 as idx, count(*) over (partition by tree) as n from d),
t(tree, level, idx, n, h) as (select tree, 0, idx, n, leaf from p
    union all select tree, level + 1, idx // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' order by idx)) from t where n > 1 group by tree, level, idx // 2),
r as (select tree, h, row_number() over (order by tree) - 1 as idx, count(*) over () as n from t where n = 1),
u(level, idx, n, h) as (select 0, idx, n, h from r
    union all select level + 1, idx // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' order by idx)) from u where n > 1 group by level, idx // 2),
f(doc_id, tree, leaf, idx, level, n, h, sibs) as (select doc_id, tree, leaf, idx, 0, n, coalesce(claimed, leaf), '' from p
    union all {_step("f", "t", "s.tree = f.tree and")}),
g(doc_id, tree, leaf, idx, level, n, h, sibs) as (select f.doc_id, f.tree, f.leaf, r.idx, 0, r.n, f.h, f.sibs from f join r on r.tree = f.tree where f.n = 1
    union all {_step("g", "u", "")})
select g.doc_id, g.leaf, r.h as subroot, u.h as root, sha256(g.sibs) as proof_sha256, g.h as folded_root, g.h = u.h as verified
from g join r on r.tree = g.tree, u where g.n = 1 and u.n = 1
"""
