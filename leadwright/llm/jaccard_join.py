"""N-gram Jaccard self-join of documents by signature trees.

Every set of shingles meets every other, by these steps, none of which keeps a frequent shingle, a large group of
copies or a long text in one place:

* Shingles in two or more documents are counted in blocks of documents (``_shared``). Only they can lie in an
  intersection: a document of which fewer than three in four shingles are shared has no partner and leaves here.
* Documents with equal sets become one class; the join works on classes.
* Tree tops: the shingles of a set in a fixed order, rare first. By the least overlap that the similarity asks for, two
  linked classes share one of the first ``n - ceil(0.75 n) + 1`` shingles of each, so a node for each such shingle,
  over the classes that have it there, leads every linked pair under a common top.
* First descent: each top's smallest class is compared with the others below it; what links is one component, and
  pairs inside a component need no further comparison.
* Second descent, under tops that still hold several components: nodes of classes of like size carry the OR of their
  bitmaps, size range and component range. Pairs of nodes under one top are dropped when the sizes cannot meet, when
  both lie in one component, or when the bits in common allow too little overlap; then pairs of classes of the nodes
  that are left go through the same test on their own bitmaps, and what passes is compared exactly.

Sets are held as 48 bits of each shingle's 64-bit hash (two hundred million shingles: one false match in 10^6 pairs of
documents at most). Links between classes are complete for the components, which is what is returned.

Defined cases: a null or empty text has no shingles and is linked with nothing; a text of fewer than five words is one
shingle; rows with the same doc_id and text are one; a null doc_id names no component unless all of it are null;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadwright.llm import tools
from leadwright.llm.components import component_labels

#: Similarity as a fraction of integers: linked when DEN * shared >= NUM * union.
NUM, DEN = 3, 4
LONGS = 16
#: A shingle in so many documents of one block is sent as a count; beyond it all frequencies rank alike.
HOT = 64
BLOCK_SHINGLES, NODE_ROWS = 2_000_000, 256
#: Rounds in which one class of each mixed top is compared with the other components there.
GUIDES = 2

#: Bytes of text to a bucket of shingles, which one Python worker holds at a time.
BUCKET_BYTES = 16 << 20
#: Tops before its own that a leaf carries, to tell that a pair has met already.
EARLIER = 8

_PART = "block long, bucket long, docs binary, tokens binary, counts binary"
_SET = ("doc_id long, text_hash long, n_shingles long, set_low long, set_high long, n int, shared binary, tops array<long>, "
        "bits array<long>, slack int")


def _pack48(tokens: np.ndarray) -> bytes:
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack48(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def _set_key(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets share: sums of two mixtures of the hashes."""
    with np.errstate(over="ignore"):
        sums = [tokens.sum(dtype=np.uint64) + np.uint64(len(tokens)), tools.mix(tokens ^ np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)]
    low, high = tools.mix(np.array(sums, np.uint64)).astype(np.int64).tolist()
    return low, high


def _blocks(buckets: int, k: int):
    """Rows of a block of documents: its shingles by bucket, and a head row with what the documents are."""

    def rows(block, ids, texts, sizes, keys, sets) -> pa.RecordBatch:
        lens = np.array([len(s) for s in sets])
        tokens = tools.concat(sets, np.uint64)
        docs = np.repeat(np.arange(len(sets), dtype=np.uint32), lens)
        order = np.argsort(tokens, kind="stable")
        tokens, docs = tokens[order], docs[order]
        first = np.flatnonzero(np.diff(tokens, prepend=tokens[:1] + np.uint64(1)) != 0) if len(tokens) else np.zeros(0, int)
        counts = np.diff(np.append(first, len(tokens)))
        hot = np.repeat(counts >= HOT, counts)
        head = pa.table({"doc_id": pa.array(ids, pa.int64()), "text_hash": pa.array(texts, pa.int64()), "n": pa.array(sizes, pa.int64()),
                         "low": pa.array([k[0] for k in keys], pa.int64()), "high": pa.array([k[1] for k in keys], pa.int64())})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, head.schema) as w:
            w.write_table(head)
        out = [(block, buckets + block % buckets, docs[hot].tobytes(), _pack48(tokens[hot]), sink.getvalue().to_pybytes())]
        top, many = tokens[first][counts >= HOT], counts[counts >= HOT].astype(np.uint32)
        docs, tokens = docs[~hot], tokens[~hot]
        at, at_top = tokens % np.uint64(buckets), top % np.uint64(buckets)
        order = np.argsort(at, kind="stable")
        docs, tokens, at = docs[order], tokens[order], at[order]
        for b in np.unique(np.concatenate((at, at_top))):
            i, j = np.searchsorted(at, b), np.searchsorted(at, b, "right")
            # Counted shingles stand in front; their counts tell how many they are.
            out.append((block, int(b), docs[i:j].tobytes(), _pack48(np.concatenate((top[at_top == b], tokens[i:j]))), many[at_top == b].tobytes()))
        return pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
            *[pa.array([r[c] for r in out], pa.binary()) for c in (2, 3, 4)]], ["block", "bucket", "docs", "tokens", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, bounds = tools.doc_texts(batch.column("text"))
            numbers, hashed = batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist()
            ids, texts, sizes, keys, sets, held = [], [], [], [], [], 0
            for a, b in tools.wide_texts(bounds):
                hashes, at = tools.word_hashes(data, bounds[a:b + 1])
                for i, s in enumerate(tools.shingles(hashes, at, k)):
                    ids.append(numbers[a + i]), texts.append(hashed[a + i]), sizes.append(len(s)), keys.append(_set_key(s))
                    short = np.unique(s & np.uint64(2**48 - 1))
                    sets.append(short)
                    held += len(short)
                if held >= BLOCK_SHINGLES:
                    yield rows(block, ids, texts, sizes, keys, sets)
                    block, ids, texts, sizes, keys, sets, held = block + 1, [], [], [], [], [], 0
            if ids:
                yield rows(block, ids, texts, sizes, keys, sets)
                block += 1

    return run


def _shared(buckets: int):
    """For a bucket of shingles: those in two or more documents, with their frequency up to HOT. Head rows pass."""

    def run(table: pa.Table) -> pa.Table:
        if not table.num_rows or table.column("bucket")[0].as_py() >= buckets:
            return table
        counts = [np.frombuffer(x.as_py(), np.uint32) for x in table.column("counts")]
        tokens = [_unpack48(x.as_py()) for x in table.column("tokens")]
        docs = [np.frombuffer(x.as_py(), np.uint32) for x in table.column("docs")]
        weights = np.concatenate([np.concatenate((c, np.ones(len(d), np.uint32))) for c, d in zip(counts, docs)])
        distinct, at = np.unique(np.concatenate(tokens), return_inverse=True)
        total = np.minimum(np.bincount(at, weights, len(distinct)), HOT).astype(np.uint8)[at]
        out, done = [], 0
        for c, t, d in zip(counts, tokens, docs):
            own = total[done + len(c):done + len(t)]
            keep = own > 1
            out.append((d[keep].tobytes(), _pack48(t[len(c):][keep]), own[keep].tobytes()))
            done += len(t)
        return pa.table([table.column("block"), table.column("bucket"), *[pa.array([r[c] for r in out], pa.binary()) for c in range(3)]],
                        ["block", "bucket", "docs", "tokens", "counts"])

    return run


def _sets(buckets: int):
    """For a block of documents: what each set shares, its first shingles and its bitmap."""

    def run(table: pa.Table) -> pa.Table:
        heads = [i for i, b in enumerate(table.column("bucket").to_pylist()) if b >= buckets]
        with pa.ipc.open_stream(table.column("counts")[heads[0]].as_py()) as r:
            head = r.read_all()
        docs, tokens, ranks = [], [], []
        for i in range(table.num_rows):
            docs.append(np.frombuffer(table.column("docs")[i].as_py(), np.uint32))
            tokens.append(_unpack48(table.column("tokens")[i].as_py()))
            ranks.append(np.full(len(docs[-1]), HOT, np.uint8) if i == heads[0] else np.frombuffer(table.column("counts")[i].as_py(), np.uint8))
        docs, tokens, ranks = np.concatenate(docs), np.concatenate(tokens), np.concatenate(ranks)
        order = np.lexsort((tokens, ranks, docs))
        docs, tokens = docs[order], tokens[order]
        bounds = np.searchsorted(docs, np.arange(head.num_rows + 1))
        sizes = head.column("n").to_numpy()
        shared, tops, bits, slacks = [], [], [], []
        for i, n in enumerate(sizes.tolist()):
            own = tokens[bounds[i]:bounds[i + 1]]
            if not n or DEN * len(own) < NUM * n:
                shared.append(None), tops.append(None), bits.append(None), slacks.append(None)
                continue
            least = -(-NUM * n // DEN)
            tops.append(own[:len(own) - least + 1].astype(np.int64))  # the first n - least + 1, without the unshared ones
            bitmap = np.zeros(LONGS * 64, np.uint8)
            bitmap[(own >> np.uint64(20)) % np.uint64(LONGS * 64)] = 1
            bits.append(np.packbits(bitmap, bitorder="little").view("<i8"))
            slacks.append(len(own) - int(bitmap.sum()))
            shared.append(_pack48(np.sort(own)))
        return pa.table([head.column("doc_id"), head.column("text_hash"), head.column("n"), head.column("low"), head.column("high"),
                         head.column("n").cast(pa.int32()),
                         pa.array(shared, pa.binary()), pa.array(tops, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64())),
                         pa.array(slacks, pa.int32())], [f.split()[0] for f in _SET.split(", ")])

    return run


def shingle_sets(docs: DataFrame, k: int = 5) -> DataFrame:
    """One row per document: set size and key; for those that can have partners also their shared shingles and bitmap."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(32, tools.partitions(docs.sparkSession), size // BUCKET_BYTES)
    counted = texts.mapInArrow(_blocks(buckets, k), _PART).groupBy("bucket").applyInArrow(_shared(buckets), _PART)
    return counted.groupBy("block").applyInArrow(_sets(buckets), _SET)


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes_a, sizes_b = batch.column("n_a").to_pylist(), batch.column("n_b").to_pylist()
        keep = []
        for i, (x, y) in enumerate(zip(batch.column("shared_a"), batch.column("shared_b"))):
            common = len(np.intersect1d(_unpack48(x.as_py()), _unpack48(y.as_py()), assume_unique=True))
            keep.append(DEN * common >= NUM * (sizes_a[i] + sizes_b[i] - common))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _verified(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose sets are similar enough, by their shingles."""
    side = lambda s: classes.select(F.col("key").alias(s), F.col("n").alias(f"n_{s}"), F.col("shared").alias(f"shared_{s}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "shared_a", "shared_b").mapInArrow(
        _linked, "a long, b long")


def _sizes_meet(small_a: Column, large_a: Column, small_b: Column, large_b: Column) -> Column:
    return (DEN * large_b >= NUM * small_a) & (DEN * large_a >= NUM * small_b)


def _bits_meet(n_a: Column, n_b: Column, slack_a: Column, slack_b: Column) -> Column:
    """Whether the bits in common allow the overlap that sets of at least these sizes need."""
    common = sum((F.bit_count(F.col(f"a.s{i}").bitwiseAND(F.col(f"b.s{i}"))) for i in range(LONGS)), F.lit(0))
    return (NUM + DEN) * (common + F.least(slack_a, slack_b)) >= NUM * (n_a + n_b)


def _held(tops: DataFrame, labels: DataFrame) -> DataFrame:
    """Leaves of the tops that still hold several components, with their component."""
    held = tops.join(labels, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    mixed = held.groupBy("top").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high").select("top")
    return held.join(mixed, "top")


def _guided(tops: DataFrame, classes: DataFrame, labels: DataFrame, seed: int) -> DataFrame:
    """Under each mixed top one class, drawn by a hash, against those of other components: a, b that may be linked."""
    held = tools.materialise(_held(tops, labels).join(classes.select("key", "n"), "key"), "tree-mixed")
    draw = F.xxhash64("key", F.lit(seed))
    guides = held.groupBy("top").agg(*[F.min_by(c, draw).alias(f"guide_{c}") for c in ("key", "comp", "n")])
    pairs = held.join(guides, "top").filter((F.col("comp") != F.col("guide_comp")) & _sizes_meet(
        F.col("n"), F.col("n"), F.col("guide_n"), F.col("guide_n")))
    return pairs.select(F.least("key", "guide_key").alias("a"), F.greatest("key", "guide_key").alias("b")).distinct()


def _second_descent(tops: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of classes in different components that the dual traversal leaves: a, b."""
    mixed = _held(tops, labels).select("top", "key", "comp")
    # A leaf carries some of the tops before this one; a pair that shares one of them has met there.
    before = classes.select("key", "n", "slack", *[f"s{i}" for i in range(LONGS)], "tops", F.posexplode("tops").alias("at", "top"))
    before = before.withColumn("earlier", F.slice("tops", F.greatest(F.col("at") - EARLIER, F.lit(0)) + 1, F.least("at", F.lit(EARLIER)))).drop("tops", "at")
    rows = before.join(mixed, ["top", "key"]).withColumn("band", F.floor(F.log("n") / F.log(F.lit(DEN / NUM))).cast("int"))
    # Large components fill nodes of their own, the others share nodes.
    own = rows.groupBy("top", "band", "comp").agg(F.count("*").alias("own"))
    both = rows.groupBy("top", "band").agg(F.count("*").alias("both"))
    nodes = lambda n: F.ceil(F.col(n) / NODE_ROWS)
    rows = rows.join(own, ["top", "band", "comp"]).join(both, ["top", "band"]).withColumn("node", F.when(
        F.col("own") >= NODE_ROWS // 4, F.xxhash64("comp", F.pmod(F.xxhash64("key"), nodes("own")))).otherwise(
        F.pmod(F.xxhash64("comp"), nodes("both")))).drop("own", "both")
    rows = tools.materialise(rows, "tree-leaves")
    tree = rows.groupBy("top", "band", "node").agg(
        F.min("n").alias("n_low"), F.max("n").alias("n_high"), F.max("slack").alias("slack"), F.min("comp").alias("low"),
        F.max("comp").alias("high"), *[F.bit_or(f"s{i}").alias(f"s{i}") for i in range(LONGS)])
    tree = tools.materialise(tree, "tree-nodes")
    c = F.col
    ordered = (c("a.band") < c("b.band")) | ((c("a.band") == c("b.band")) & (c("a.node") <= c("b.node")))
    apart = ~((c("a.low") == c("a.high")) & (c("b.low") == c("b.high")) & (c("a.low") == c("b.low")))
    pairs = tree.alias("a").join(tree.alias("b"), c("a.top") == c("b.top")).filter(
        ordered & apart & _sizes_meet(c("a.n_low"), c("a.n_high"), c("b.n_low"), c("b.n_high")) & _bits_meet(
            c("a.n_low"), c("b.n_low"), c("a.slack"), c("b.slack"))).select(
        c("a.top").alias("top"), c("a.band").alias("band_a"), c("a.node").alias("node_a"), c("b.band").alias("band_b"), c("b.node").alias("node_b"))
    left = rows.withColumnsRenamed({"band": "band_a", "node": "node_a"}).alias("a")
    right = rows.withColumnsRenamed({"band": "band_b", "node": "node_b"}).alias("b")
    # Both orders of a pair meet where a node meets itself; one is enough.
    once = (c("band_a") != c("band_b")) | (c("node_a") != c("node_b")) | (c("a.key") < c("b.key"))
    found = pairs.join(left, ["top", "band_a", "node_a"]).join(right, ["top", "band_b", "node_b"]).filter(
        (c("a.comp") != c("b.comp")) & once & _sizes_meet(c("a.n"), c("a.n"), c("b.n"), c("b.n")) & _bits_meet(
            c("a.n"), c("b.n"), c("a.slack"), c("b.slack")) & ~F.arrays_overlap("a.earlier", "b.earlier"))
    return found.select(F.least("a.key", "b.key").alias("a"), F.greatest("a.key", "b.key").alias("b")).distinct()


def _grouped(docs: DataFrame, k: int) -> DataFrame:
    """Every row with doc_id, text_hash, n_shingles, its component (``root``; null: none but itself), component_id and class_size."""
    sets = tools.materialise(shingle_sets(docs, k), "shingle-sets")
    able = sets.filter("shared IS NOT NULL")
    # Numbered as they are written: a class is known by its 128 bits or by its number, never by fewer bits.
    classes = tools.materialise(able.dropDuplicates(["set_low", "set_high"]).select(
        F.monotonically_increasing_id().alias("key"), "set_low", "set_high", "n", "shared", "tops", "slack",
        *[F.get("bits", F.lit(i)).alias(f"s{i}") for i in range(LONGS)]), "classes")
    listed = classes.select("key", F.explode("tops").alias("top"))
    heads = listed.groupBy("top").agg(F.count("*").alias("m"), F.min("key").alias("head")).filter("m > 1").select("top", "head")
    tops = tools.materialise(listed.join(heads, "top"), "tree-tops")
    first = tops.filter("key <> head").select(F.col("head").alias("a"), F.col("key").alias("b")).distinct()
    links = tools.materialise(_verified(first, classes), "links")
    labels = component_labels(links)
    for seed in range(GUIDES):
        more = _verified(_guided(tops.select("key", "top"), classes, labels, seed), classes)
        links = tools.materialise(labels.select(F.col("key").alias("a"), F.col("comp").alias("b")).unionByName(more), "links")
        labels = component_labels(links)
    more = _verified(_second_descent(tops.select("key", "top"), classes, labels), classes)
    joined = more.join(labels.select(F.col("key").alias("a"), F.col("comp").alias("comp_a")), "a", "left").join(
        labels.select(F.col("key").alias("b"), F.col("comp").alias("comp_b")), "b", "left").select(
        F.coalesce("comp_a", "a").alias("a"), F.coalesce("comp_b", "b").alias("b"))
    higher = component_labels(tools.materialise(joined, "links-between")).select(F.col("key").alias("comp"), F.col("comp").alias("root"))
    roots = classes.select("key", "set_low", "set_high").join(labels, "key", "left").withColumn("comp", F.coalesce("comp", "key")).join(
        higher, "comp", "left").select("set_low", "set_high", F.coalesce("root", "comp").alias("root"))
    members = able.groupBy("set_low", "set_high").agg(F.min("doc_id").alias("low"), F.count("*").alias("class_size"))
    roots = tools.materialise(members.join(roots, ["set_low", "set_high"]), "roots")
    lowest = roots.groupBy("root").agg(F.min("low").alias("component_id"))
    grouped = able.select("doc_id", "text_hash", "n_shingles", "set_low", "set_high").join(
        roots.join(lowest, "root").select("set_low", "set_high", "root", "component_id", "class_size"), ["set_low", "set_high"]).select(
        "doc_id", "text_hash", "n_shingles", "root", "component_id", "class_size")
    alone = sets.filter("shared IS NULL").select(
        "doc_id", "text_hash", "n_shingles", F.lit(None).cast("long").alias("root"), F.col("doc_id").alias("component_id"),
        F.lit(1).cast("long").alias("class_size"))
    return grouped.unionByName(alone)


def near_duplicates(docs: DataFrame, k: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id that links reach) and class_size (documents with the same set)."""
    return _grouped(docs, k).select("doc_id", "n_shingles", "component_id", "class_size")


def one_per_group(docs: DataFrame, k: int = 5) -> DataFrame:
    """One document of each component, the one with the smallest doc_id (then text hash, a null id last), with the input's columns.

    Documents are told apart by doc_id and text: a text that shares its id with a copy is judged for itself, and of rows
    that agree in both one stays.
    """
    found = tools.materialise(_grouped(docs, k).select("doc_id", "text_hash", "root"), "groups")
    worth = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    best = found.filter("root IS NOT NULL").groupBy("root").agg(F.min(worth).alias("best"))
    same = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & F.col("text_hash").eqNullSafe(F.col("best.text_hash"))
    others = found.filter("root IS NOT NULL").join(best, "root").filter(~same).select("doc_id", "text_hash").distinct()
    twice = tools.materialise(found.groupBy("doc_id", "text_hash").agg(F.count("*").alias("rows")).filter("rows > 1").select(
        "doc_id", "text_hash"), "groups-repeated")
    columns = [docs[f"`{c}`"] for c in docs.columns]
    given = docs.select(F.struct(*columns).alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"))
    meets = lambda t: given["id"].eqNullSafe(t["doc_id"]) & (given["hash"] == t["text_hash"])
    kept = given.join(others, meets(others), "left_anti")
    if not twice.isEmpty():
        met = kept.join(twice, given["id"].eqNullSafe(twice["doc_id"]) & (given["hash"] == twice["text_hash"]), "left_semi")
        kept = kept.join(twice, given["id"].eqNullSafe(twice["doc_id"]) & (given["hash"] == twice["text_hash"]), "left_anti").unionByName(
            met.dropDuplicates(["id", "hash"]))
    return kept.select("row.*")
