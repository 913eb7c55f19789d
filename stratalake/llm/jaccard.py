"""N-gram Jaccard join with adaptive multi-match prefixes.

Shingles are ordered by their hash. Two documents of m <= n shingles and similarity 3/4 or more share at least
l of the first n - ceil(3n/4) + l shingles of each, for every l. So a document's prefix is lengthened to
l = 1 + n div `share`, and a pair is verified only if it has as many prefix shingles in common as the smaller l of the two asks. Shingles that only one prefix holds
drop out; of the others a document may leave out the l' - 1 most frequent ones, where l' is the least l of
any document it can link with, and a document with no more than that many has no links at all. What is left
ties documents into clusters across which nothing links. The estimated candidate cost of a document is the size of its cluster:
where it is too high, the prefixes of the documents are lengthened further (share 8, 4, then 2) and more common
shingles are needed, which takes the cluster apart. All documents of a cluster are lengthened alike, as each may be the other's candidate.

Within a cluster, common prefix shingles are counted for each pair and the pairs that have enough are verified on whole sets, unless they are
connected already. Clusters that stay large are first compared with a few pivots each; documents that link with the same pivot
need not meet again, so that a group of near copies costs its size, not its square. The others meet in pairs of
blocks. Only a spanning forest of the links leaves a task.

Defined results: null texts and texts without words have no shingles and link with nothing; equal sets link and are
compared once, by their smallest doc_id; rows that share a doc_id are one document; a null doc_id counts only
through documents with the same shingles; other columns are ignored (keep_one keeps them), whatever their names; a very long text is a slice of its
own and needs some 60 bytes of memory for each of its own; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm import kernels as K
from stratalake.llm.components import Forest, components
from stratalake.llm.tables import documents, small, written

WORDS = 5
SHARES = (8, 4, 2)
#: The largest cluster that one task verifies, in documents and in shingles, and the size of a block of larger ones.
CLUSTER_DOCS, CLUSTER_SHINGLES, BLOCK_DOCS = 250, 4_000_000, 500
#: Pivots of a large cluster in a round; rounds go on while they link this share of the documents that are left.
PIVOTS, WORTH = 16, 0.1
#: Columns of a matrix product.
COLUMNS = 8192
#: Prefix shingles of a bucket, about, the most buckets, and how many shingles a task deals out at a time.
BUCKET_SHINGLES, BUCKETS, DEALT_SHINGLES = 1 << 19, 1 << 16, 1 << 20
#: Documents that hold a shingle are counted up to here.
MOST_HOLDERS = (1 << 15) - 1
#: The least sizes of bands: documents of bands that aren't neighbours differ by more than 4 : 3.
BANDS = [1]
while BANDS[-1] < 1 << 40:
    BANDS.append(4 * BANDS[-1] // 3 + 1)


def summaries(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, digest of the set) of each row."""

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, data, offsets in K.slices(batch.column(1)):
                sets = K.shingle_sets(data, offsets, k)
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary())], names=["doc_id", "n_shingles", "digest"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(summary, "doc_id bigint, n_shingles bigint, digest binary")


def prefix_length(n: np.ndarray, share: int) -> np.ndarray:
    return np.minimum(n, n - -(-3 * n // 4) + 1 + n // share)


def _planes(x: np.ndarray) -> bytes:
    """Differences of whole numbers, their lowest bytes first, then the next ones: bytes that are all alike compress well."""
    return np.diff(x, prepend=np.int64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.int64).ravel())


def _dealt(tokens: np.ndarray, own: np.ndarray, buckets: int) -> pa.RecordBatch:
    bucket = ((tokens >> np.uint64(32)) % np.uint64(buckets)).astype(np.uint16)
    order = np.argsort(bucket, kind="stable")
    bucket, tokens, own = bucket[order], tokens[order].astype(np.uint32), own[order]
    bounds = np.append(np.flatnonzero(np.diff(bucket, prepend=bucket[:1] + 1)), len(bucket))
    parts = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
    columns = [pa.array([tokens[x:y].tobytes() for x, y in parts], pa.binary()), pa.array([_planes(own[x:y]) for x, y in parts], pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array(bucket[bounds[:-1]].astype(np.int32)), *columns], names=["bucket", "toks", "docs"])


def prefixes(docs: DataFrame, share: int, buckets: int, k: int = WORDS) -> DataFrame:
    """(bucket, toks, docs): the shingles of each document's prefix, dealt to buckets by their hash, many in a row: 32 of its other bits, and the documents."""

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at, end, data, offsets in K.slices(batch.column(1)):
                sets = K.shingle_sets(data, offsets, k)
                length = prefix_length(np.array([len(s) for s in sets], np.int64), share)
                held.append((np.concatenate([s[:n] for s, n in zip(sets, length)]).astype(np.uint64), np.repeat(ids[at:end], length)))
                size += len(held[-1][0])
                if size >= DEALT_SHINGLES:
                    yield _dealt(*map(np.concatenate, zip(*held)), buckets)
                    held, size = [], 0
        if size:
            yield _dealt(*map(np.concatenate, zip(*held)), buckets)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(prefix, "bucket int, toks binary, docs binary")


def _held_by_several(group: pa.Table) -> pa.Table:
    """(doc, tok) of a bucket's shingles that are held more than once; they are numbered so that rarer ones come first."""
    tok = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in group.column("toks")])
    doc = np.concatenate([_from_planes(x.as_py()) for x in group.column("docs")])
    _, at, count = np.unique(tok, return_inverse=True, return_counts=True)
    several = count[at] > 1
    holders = np.minimum(count[at][several], MOST_HOLDERS)
    return pa.table({"doc": doc[several], "tok": holders << 48 | np.int64(group.column("bucket")[0].as_py()) << 32 | tok[several].astype(np.int64)})


def clusters(docs: DataFrame, sizes: DataFrame, share: int, k: int = WORDS) -> DataFrame:
    """(doc, cluster) of the documents that can have a link, for `docs` and their `sizes` (doc, n).

    Most prefix shingles are held once, and no row is made of these. Shingles that agree in a bucket and 32 bits count as one, which can
    only tie more documents; one that a document then holds twice stays twice in its list, so that as many are left as the links ask for.
    """
    shingles = sizes.agg(F.sum("n")).first()[0] or 0
    buckets = min(BUCKETS, 1 + int(shingles * (0.25 + 1 / share)) // BUCKET_SHINGLES)
    tokens = prefixes(docs, share, buckets, k).groupBy("bucket").applyInArrow(_held_by_several, "doc bigint, tok bigint")
    held = tokens.groupBy("doc").agg(F.sort_array(F.collect_list("tok")).alias("held"))
    left_out = F.expr(f"((3 * n + 3) div 4) div {share}")
    kept = held.join(sizes, "doc").withColumn("keep", (F.size("held") - left_out).cast("int")).filter("keep > 0")
    shared = written(kept.select("doc", F.explode(F.slice("held", F.lit(1), F.col("keep"))).alias("tok")), "shared")
    first = shared.groupBy("tok").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("c")).filter("c > 1")
    ties = shared.join(written(first, "first"), "tok").filter("doc <> first").select("doc", "first")
    roots = components(ties)
    return roots.select(F.col("u").alias("doc"), F.col("v").alias("cluster")).union(roots.select(F.col("v").alias("doc"), F.col("v").alias("cluster")).distinct())


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The sizes of all intersections of two lists of sorted sets, by products of 0/1 matrices."""
    each = [*left, *right]
    own = np.repeat(np.arange(len(each)), [len(s) for s in each])
    _, column, count = np.unique(np.concatenate(each), return_inverse=True, return_counts=True)
    common = count[column] > 1
    place = (np.cumsum(count > 1) - 1)[column[common]]
    own = own[common]
    order = np.argsort(place, kind="stable")
    place, own = place[order], own[order]
    out = np.zeros((len(left), len(right)), np.float32)
    at = 0
    while at < len(place):
        low = place[at]
        end = int(np.searchsorted(place, low + COLUMNS))
        m = np.zeros((len(each), min(COLUMNS, int(place[end - 1] - low) + 1)), np.float32)
        m[own[at:end], place[at:end] - low] = 1
        out += m[: len(left)] @ m[len(left) :].T
        at = end
    return out


def verified(ids: list[int], sets: list[np.ndarray], share: int, side: list[int] | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links among sets; with `side` (0 or 1), of those between the two sides."""
    forest, n = Forest(), np.array([len(s) for s in sets], np.int64)
    a = np.array([x for x in range(len(ids)) if side is None or side[x] == 0], np.int64)
    b = a if side is None else np.array([x for x in range(len(ids)) if side[x] == 1], np.int64)
    if not len(a) or not len(b) or len(ids) < 2:
        return []
    prefixes_, need = [s[:m] for s, m in zip(sets, prefix_length(n, share))], 1 + n // share
    common = overlaps([prefixes_[x] for x in a], [prefixes_[x] for x in b])
    fit = (common >= np.minimum(need[a][:, None], need[b][None, :])) & (100 * np.minimum(n[a][:, None], n[b][None, :]) >= 75 * np.maximum(n[a][:, None], n[b][None, :]))
    if side is None:
        fit = np.triu(fit, 1)
    failed, left = 0, []
    for x, y in zip(*(v.tolist() for v in np.nonzero(fit))):
        i, j = int(a[x]), int(b[y])
        if forest.find(ids[i]) == forest.find(ids[j]):
            continue
        if failed > 2 * len(ids):  # many pairs that do not link are cheaper together
            left.append((x, y))
            continue
        both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        if 100 * both >= 75 * (n[i] + n[j] - both):
            forest.join(ids[i], ids[j])
        else:
            failed += 1
    if left:
        whole = overlaps([sets[x] for x in a], [sets[x] for x in b]).astype(np.int64)
        for x, y in left:
            i, j, both = int(a[x]), int(b[y]), int(whole[x, y])
            if 100 * both >= 75 * (n[i] + n[j] - both):
                forest.join(ids[i], ids[j])
    return forest.links()


def _verify(group: pa.Table) -> pa.Table:
    sets = [np.frombuffer(x.as_py(), np.uint64) for x in group.column("tokens")]
    i, j, share = (group.column(c)[0].as_py() for c in ("i", "j", "share"))
    side = None if i == j else [int(x == j) for x in group.column("b").to_pylist()]
    links = verified(group.column("doc").to_pylist(), sets, share, side)
    return pa.table([pa.array([x[n] for x in links], pa.int64()) for n in (0, 1)], names=["u", "v"])


def links(docs: DataFrame, placed: DataFrame, k: int = WORDS) -> DataFrame:
    """(u, v): spanning links from whole sets; `placed` has (doc, cluster, share, b, others): its block, and the blocks to meet."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, data, offsets in K.slices(batch.column(5)):
                sets = [s.tobytes() for s in K.shingle_sets(data, offsets, k)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(at, end - at) for c in range(5)), pa.array(sets, pa.binary())], names=["doc", "cluster", "share", "b", "others", "tokens"])

    chosen = docs.join(small(placed), docs["doc_id"] == placed["doc"]).select("doc", "cluster", "share", "b", "others", "text")
    sets = chosen.mapInArrow(packed, "doc bigint, cluster bigint, share int, b bigint, others array<bigint>, tokens binary")
    met = sets.withColumn("o", F.explode("others")).withColumns({"i": F.least("b", "o"), "j": F.greatest("b", "o")}).drop("o", "others")
    return met.groupBy("cluster", "i", "j").applyInArrow(_verify, "u bigint, v bigint")


def _n_blocks(docs: Column, shingles: Column) -> Column:
    return F.ceil(F.greatest(docs / BLOCK_DOCS, shingles / (CLUSTER_SHINGLES // 2))).cast("long")


def _to(low: Column, high: Column) -> Column:
    """The whole numbers from low up to but without high."""
    return F.when(low < high, F.sequence(low, high - 1)).otherwise(F.array().cast("array<bigint>"))


def pivot_links(docs: DataFrame, large: DataFrame, share: int, k: int = WORDS) -> DataFrame:
    """(u, v): links of the documents of large clusters (doc, cluster, n) with pivots, over some rounds."""
    rest, out = large, None
    zero = F.lit(0).cast("long")
    while True:
        drawn = F.pmod(F.xxhash64("doc"), F.lit(PIVOTS))
        pivots = rest.groupBy("cluster", drawn).agg(F.min_by("doc", F.xxhash64("doc")).alias("doc")).select("doc", F.lit(True).alias("pivot"))
        sizes = rest.groupBy("cluster").agg((_n_blocks(F.count(F.lit(1)), F.sum("n")) + 1).alias("blocks"))
        placed = rest.join(sizes, "cluster").join(written(pivots, "pivots"), "doc", "left")
        # Pivots are block 0, which meets all others and itself.
        b = F.when(F.col("pivot"), zero).otherwise(1 + F.pmod(F.xxhash64("doc"), F.col("blocks") - 1))
        placed = placed.select("doc", "cluster", F.lit(share).alias("share"), b.alias("b"), F.when(F.col("pivot"), _to(zero, F.col("blocks"))).otherwise(F.array(zero)).alias("others"))
        found = written(links(docs, written(placed, "placed"), k), "pivot-links")
        out = found if out is None else out.union(found)
        linked = found.select(F.explode(F.array("u", "v")).alias("doc")).distinct()
        left = written(rest.join(linked, "doc", "left_anti"), "left")
        before, after = rest.count(), left.count()
        if not after or before - after < WORTH * before:
            return out
        rest = left


def large_links(docs: DataFrame, large: DataFrame, share: int, k: int = WORDS) -> DataFrame:
    """(u, v): spanning links of the large clusters (doc, cluster, n), by pivots and then by pairs of blocks whose documents have sizes that can link."""
    by_pivot = written(pivot_links(docs, large, share, k), "pivot-links")
    roots = components(by_pivot)
    core = roots.union(roots.select("v", "v").distinct()).toDF("doc", "core")
    band = F.size(F.filter(F.array(*[F.lit(x).cast("long") for x in BANDS]), lambda x: x <= F.col("n")))
    members = written(large.join(core, "doc", "left").withColumn("band", band), "members")
    parts = members.groupBy("cluster", "core", "band").agg(_n_blocks(F.count(F.lit(1)), F.sum("n")).alias("blocks"))
    # A cluster has as many cores as pivots at most, and one part of all documents without one, each in at most len(BANDS) bands.
    parts = written(parts.withColumn("first", F.sum("blocks").over(Window.partitionBy("cluster").orderBy("core", "band")) - F.col("blocks")), "parts")
    a, b = parts.withColumn("near", F.explode(F.array(*[F.col("band") + x for x in (-1, 0, 1)]))).alias("a"), parts.alias("b")
    near = (F.col("a.cluster") == F.col("b.cluster")) & (F.col("a.near") == F.col("b.band")) & (F.col("a.core").isNull() | ~F.col("a.core").eqNullSafe(F.col("b.core")))
    others = F.flatten(F.collect_list(_to(F.col("b.first"), F.col("b.first") + F.col("b.blocks"))))
    met = a.join(b, near).groupBy(*[F.col(f"a.{c}").alias(f"p_{c}") for c in ("cluster", "core", "band", "first", "blocks")]).agg(others.alias("others"))
    same = (F.col("cluster") == F.col("p_cluster")) & (F.col("band") == F.col("p_band")) & F.col("core").eqNullSafe(F.col("p_core"))
    placed = members.join(small(written(met, "met")), same)
    placed = placed.select("doc", "cluster", F.lit(share).alias("share"), (F.col("p_first") + F.pmod(F.xxhash64("doc"), F.col("p_blocks"))).alias("b"), "others")
    return by_pivot.union(links(docs, written(placed, "placed"), k))


def component_ids(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row."""
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    rows = written(summaries(docs, k), "summaries")
    classes = rows.filter("n_shingles > 0").groupBy("digest", "n_shingles").agg(F.min("doc_id").alias("doc"), F.count(F.lit(1)).alias("c"))
    classes = written(classes, "classes")
    named = rows.join(classes.select("digest", "doc"), "digest", "left")
    copies = named.filter("doc_id is null or doc is null or doc_id <> doc").select("doc_id").distinct()
    several = rows.groupBy("doc_id").agg(F.count_distinct("digest").alias("c")).filter("c > 1 and doc_id is not null")
    first = docs.filter("doc_id is not null")
    # A document whose rows differ is kept as a whole; any of its rows may be the one that links.
    first = first.join(small(written(copies.join(several, "doc_id", "left_anti"), "copies")), "doc_id", "left_anti")
    sizes = classes.filter("doc is not null").groupBy("doc").agg(F.min("n_shingles").alias("n"))
    members, parts = first, []
    for share in SHARES:
        found = clusters(members, sizes, share, k).join(sizes, "doc")
        cost = found.groupBy("cluster").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("shingles"))
        found = written(found.join(cost, "cluster"), "clusters")
        large = (F.col("docs") > CLUSTER_DOCS) | (F.col("shingles") > CLUSTER_SHINGLES)
        zero = F.lit(0).cast("long")
        parts.append(found.filter(~large).select("doc", "cluster", F.lit(share).alias("share"), zero.alias("b"), F.array(zero).alias("others")))
        rest = found.filter(large).select("doc", "cluster", "n")
        if rest.isEmpty():
            break
        # What is left is read several times more, so it is written.
        members = written(members.join(small(rest.select(F.col("doc").alias("doc_id"))), "doc_id", "left_semi"), "members")
        sizes = rest.select("doc", "n")
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    edges = links(first, written(found, "candidates"), k)
    if not rest.isEmpty():
        edges = edges.union(large_links(members, rest, share, k))
    same = named.join(several, "doc_id", "left_semi").filter("doc is not null").select(F.col("doc_id").alias("u"), F.col("doc").alias("v"))
    roots = components(edges.union(same))
    out = named.join(roots, F.coalesce("doc", "doc_id") == F.col("u"), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("v", "doc", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """One row of `docs` of each group of near duplicates, with all its columns: that with the smallest doc_id (null ids last), then text hash.

    Groups are of rows, whatever their ids: rows that share an id, or have none, but not a text stay apart. Rows without shingles all stay.
    """
    key = F.xxhash64("doc_id", "text")
    keyed = docs.select(F.col("doc_id").cast("long").alias("id"), key.alias("key"), "text")
    found = written(component_ids(keyed.select(F.col("key").alias("doc_id"), "text"), k).filter("n_shingles > 0").distinct(), "components")
    ids = keyed.groupBy("key").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("rows"))
    groups = found.select(F.col("doc_id").alias("key"), F.col("component_id").alias("group")).distinct().join(ids, "key")
    best = groups.groupBy("group").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key"))["key"].alias("best"))
    state = written(groups.join(best, "group").filter("key <> best or rows > 1").select(F.col("key").alias("_key"), (F.col("key") == F.col("best")).alias("_stays")), "dropped")
    kept = docs.join(small(state.filter("not _stays").select("_key")), key == F.col("_key"), "left_anti")
    again = state.filter("_stays").select("_key")
    if again.isEmpty():
        return kept
    # Rows that repeat a document as a whole: any one of them stays.
    repeated = kept.withColumn("_one", key).join(small(again), F.col("_one") == F.col("_key"), "left_semi").dropDuplicates(["_one"]).drop("_one")
    return kept.join(small(again), key == F.col("_key"), "left_anti").unionByName(repeated)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return component_ids(documents(spark, sf_dir))


OP7_SQL = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
s as (select distinct doc_id, array_to_string(ws[i : i + 4], ' ') as g from w, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) r(i) where len(ws) > 0),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as x, b.doc_id as y, count(*) as shared from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
e as (select x, y from p join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 100 * shared >= 75 * (nx.n + ny.n - shared)),
l as (select x, y from e union all select y, x from e),
r as (select doc_id, doc_id as at from documents union select r.doc_id, l.y from r join l on r.at = l.x)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, min(r.at) as component_id from documents d join r on r.doc_id = d.doc_id left join n on n.doc_id = d.doc_id group by all
"""
