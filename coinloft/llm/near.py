"""Near-copy removal with ProbMinHash: weighted and plain word shingles, banding, verification, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coinloft.llm import text as X
from coinloft.llm.graph import components
from coinloft.session import cut_lineage

SIMILARITY = 0.8
ROWS, BANDS = 5, 32  # a pair at 0.8 meets in no band with probability 3e-6
PAIRED = 50  # members up to which a bucket's open pairs are compared directly
SAMPLED, COMMON = 64, 4096  # texts of a cluster that tell its common shingles, and how many of these; they set speed, not results
SKETCH_CHUNK = 1 << 20
_U = np.uint64


def prob_minhash(elements: np.ndarray, rows: np.ndarray, weights: np.ndarray, n_rows: int, slots: int) -> np.ndarray:
    """(n_rows, slots) signature: in each slot the 32-bit mark of the element that arrives there first.

    Every element sends arrivals of a Poisson process whose rate is its weight, each into a random slot. Once an
    element's latest arrival is later than the latest of its row's slots, none of its later ones can win and it stops.
    Two rows agree in a slot with the probability Jaccard similarity of their weights. Rows without elements keep zeros.
    """
    best = np.full(n_rows * slots, np.iinfo(np.uint64).max, np.uint64)
    active = np.arange(len(elements))
    time = np.zeros(len(elements))
    step = 0
    mark = X.mix(elements) >> _U(32)
    with np.errstate(over="ignore"):
        while len(active):
            block = int(np.clip(4096 // len(active), 1, 64))
            tick = np.arange(step + 1, step + block + 1, dtype=np.uint64) * _U(0xD1342543DE82EF95)
            step += block
            random = X.mix(elements[active][:, None] + tick[None, :])
            wait = -np.log1p(-(random >> _U(11)).astype(np.float64) * 2.0**-53) / weights[active][:, None]
            arrival = time[active][:, None] + np.cumsum(wait, axis=1)
            time[active] = arrival[:, -1]
            slot = (X.mix(random) >> _U(32)) * _U(slots) >> _U(32)
            key = arrival.astype(np.float32).view(np.uint32).astype(np.uint64) << _U(32) | mark[active][:, None]
            np.minimum.at(best, (rows[active][:, None] * slots + slot.astype(np.int64)).ravel(), key.ravel())
            open_rows = np.unique(rows[active])
            last = np.zeros(n_rows, np.uint64)
            last[open_rows] = best.reshape(n_rows, slots)[open_rows].max(axis=1)
            active = active[key[:, -1] < last[rows[active]]]
    best[best == np.iinfo(np.uint64).max] = 0
    return (best & _U(0xFFFFFFFF)).reshape(n_rows, slots)


def _counted(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, their rows; distinct shingles, their rows and counts, ordered by row and shingle."""
    n = len(offsets) - 1
    hashes, rows = X.words(data, offsets)
    found, at = X.shingles(hashes, rows, n)
    order = np.lexsort((found, at))
    found, at = found[order], at[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (at[1:] != at[:-1])
    first = np.flatnonzero(new)
    return hashes, rows, found[first], at[first], np.diff(np.append(first, len(found)))


def _bands(shingle: np.ndarray, rows: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """(n, BANDS) keys, each of ROWS slots of the signature."""
    factors = X.seeds(ROWS * BANDS, 29).reshape(BANDS, ROWS) | _U(1)
    with np.errstate(over="ignore"):
        signature = prob_minhash(shingle, rows, weights, n, ROWS * BANDS).reshape(n, BANDS, ROWS)
        return X.mix((signature * factors[None]).sum(axis=2, dtype=np.uint64) + X.seeds(BANDS, 31)[None])


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bands of the weighted shingles, and, if a text repeats any, of its set of shingles too.

    A text without repeats has the same bands either way, so every two texts meet with the probability that their sets give.
    """
    for batch in batches:
        for first, end, data, offsets in X.chunks(batch.column("text"), SKETCH_CHUNK):
            n = end - first
            hashes, word_rows, shingle, rows, count = _counted(data, offsets)
            band = _bands(shingle, rows, 1 + np.log2(count), n)
            again = np.unique(rows[count > 1])
            part = np.isin(rows, again)
            plain = _bands(shingle[part], np.searchsorted(again, rows[part]), np.ones(int(part.sum())), len(again))
            keys = X.sequence_keys(hashes, word_rows, n).view(np.int64)
            n_words = np.bincount(word_rows, minlength=n)
            cut = np.arange(n + 1) + np.searchsorted(again, np.arange(n + 1))  # lists of bands before each row
            lists = np.insert(band, again + 1, plain, axis=0)
            bands = pa.ListArray.from_arrays(pa.array(cut * BANDS, pa.int32()), pa.array(lists.view(np.int64).ravel()))
            own = [batch.column(c).slice(first, n) for c in ("doc_id", "p1", "p2")]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(n_words.astype(np.int64)), pa.array(keys[:, 0]), pa.array(keys[:, 1]), bands],
                ["doc_id", "p1", "p2", "n_words", "k1", "k2", "bands"],
            )


def _shingle_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, offsets in X.chunks(batch.column("text"), SKETCH_CHUNK):
            *_, shingle, rows, _ = _counted(data, offsets)
            cut = np.searchsorted(rows, np.arange(end - first + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(cut), pa.array(shingle.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(first, end - first), lists], ["id", "shingles"])


def _verified(pairs: DataFrame, lists: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets have a Jaccard similarity of at least ``similarity``.

    A node with very many partners is always ``b``: the second join, whose large partitions Spark splits, brings its list.
    """
    left = lists.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = lists.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(left, "a").join(right, "b").where(both >= similarity * (F.size("sa") + F.size("sb") - both)).select("a", "b")


def _rare_pairs(nodes: DataFrame, lists: DataFrame, similarity: float) -> DataFrame:
    """All pairs (a, b) of one cluster and different components that may reach ``similarity``: they share a shingle at the
    head of their lists. ``nodes`` has id, component, cluster.

    In any order that is the same for all lists of a cluster, of n shingles the first n - ceil(similarity n) + 1 must hold
    one that both texts have, and what follows the first common one must suffice for the similarity. So the order is
    free: the shingles seen most often in SAMPLED texts of the cluster, COMMON of them at most, come last. Only heads are written out.
    """
    listed = nodes.withColumn("place", F.row_number().over(W.partitionBy("cluster").orderBy(F.xxhash64("id"), "id")))
    some = listed.where(f"place <= {SAMPLED}").select("id", "cluster").join(lists, "id")
    seen = some.select("cluster", F.explode("shingles").alias("s")).groupBy("cluster", "s").agg(F.count("*").alias("f")).where("f > 1")
    most = seen.withColumn("place", F.row_number().over(W.partitionBy("cluster").orderBy(F.desc("f"), "s"))).where(f"place <= {COMMON}")
    common = cut_lineage(most.groupBy("cluster").agg(F.collect_list("s").alias("common")), "common-shingles")
    held = nodes.join(lists, "id").join(common, "cluster", "left").withColumn("n", F.size("shingles"))
    common_of = F.coalesce("common", F.expr("cast(array() as array<bigint>)"))
    ordered = F.concat(F.array_sort(F.array_except("shingles", common_of)), F.array_sort(F.array_intersect("shingles", common_of)))
    lead = F.expr(f"n - ceil({similarity} * n) + 1").cast("int")
    token = held.select("id", "component", "cluster", "n", F.posexplode(F.slice(ordered, F.lit(1), lead)).alias("i", "s"))
    token = cut_lineage(token.withColumn("rest", F.col("n") - F.col("i")).drop("i"), "heads")
    mixed = token.groupBy("cluster", "s").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    token = cut_lineage(token.join(mixed.select("cluster", "s"), ["cluster", "s"]), "shared-heads")
    x, y = token.alias("x"), token.alias("y")
    enough = F.least("x.rest", "y.rest") >= F.lit(similarity / (1 + similarity)) * (F.col("x.n") + F.col("y.n")) - 1e-9
    other = (F.col("x.id") > F.col("y.id")) & (F.col("x.component") != F.col("y.component"))
    same = (F.col("x.cluster") == F.col("y.cluster")) & (F.col("x.s") == F.col("y.s"))
    return x.join(y, same & other & enough).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()


def _grouped(docs: DataFrame, similarity: float) -> DataFrame:
    """doc_id, p1, p2, class_id, group_id, kept per row of ``docs`` (doc_id, p1, p2, text); see ``near_copies``."""
    sketch = docs.mapInArrow(_sketch, "doc_id long, p1 long, p2 long, n_words long, k1 long, k2 long, bands array<long>")
    sketch = cut_lineage(sketch, "sketches")
    worded = sketch.where("n_words > 0")
    # a row without a doc_id stands behind all others; equal ids are told apart by their prints
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "p1", "p2")
    classes = worded.groupBy("k1", "k2").agg(F.min(row).alias("first"), F.min("bands").alias("bands"))
    # ids ascend with the least row: a bucket's least node is then its earliest document, which most of a group's buckets share
    by = [F.col("first.none"), F.col("first.doc_id"), F.col("first.p1"), F.col("first.p2")]
    ranged = cut_lineage(classes, "class-rows").repartitionByRange(*by).sortWithinPartitions(*by)
    classes = cut_lineage(ranged.withColumn("id", F.monotonically_increasing_id()), "classes")
    member = classes.select("id", F.explode(F.array_distinct("bands")).alias("bucket"))
    bucket = member.groupBy("bucket").agg(F.min("id").alias("b"), F.count("*").alias("members")).where("members > 1")
    member = cut_lineage(member.join(bucket, "bucket"), "buckets")  # of shared buckets only

    nodes = classes.join(member.select("id").distinct(), "id", "left_semi").select("id", F.col("first.p1").alias("p1"), F.col("first.p2").alias("p2"))
    lists = docs.select("p1", "p2", "text").join(nodes, ["p1", "p2"]).select("id", "text").mapInArrow(_shingle_lists, "id long, shingles array<long>")
    lists = cut_lineage(lists.groupBy("id").agg(F.first("shingles").alias("shingles")), "shingles")

    star = member.where("id <> b").select(F.col("id").alias("a"), "b").distinct()
    links = cut_lineage(_verified(star, lists, similarity), "links")
    label = components(links)

    named = member.join(label, "id", "left").select("bucket", "members", "b", "id", F.coalesce("component", "id").alias("component"))
    split = named.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("bucket")
    open_ = cut_lineage(named.join(split, "bucket"), "open-buckets")
    if not open_.isEmpty():
        small = open_.where(f"members <= {PAIRED}")
        x, y = small.alias("x"), small.alias("y")
        pairs = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.id") > F.col("y.id")) & (F.col("x.component") != F.col("y.component")))
        pairs = pairs.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
        large = open_.where(f"members > {PAIRED}")
        if not large.isEmpty():
            # texts of different clusters share no such bucket
            cluster = components(large.select(F.col("id").alias("a"), "b").distinct()).withColumnRenamed("component", "cluster")
            pairs = pairs.union(_rare_pairs(large.select("id", "component").distinct().join(cluster, "id"), lists, similarity))
        more = cut_lineage(_verified(pairs.distinct().join(star, ["a", "b"], "left_anti"), lists, similarity), "links")
        if not more.isEmpty():
            label = components(links.union(more))

    linked = classes.select("id", "first").join(label, "id")
    least = linked.groupBy("component").agg(F.min("first").alias("least"))
    of_node = label.join(least, "component").select("id", "least")
    of_class = classes.join(of_node, "id", "left").select("k1", "k2", "first", F.coalesce("least", "first").alias("least"))
    grouped = worded.select("doc_id", "p1", "p2", "k1", "k2").join(of_class, ["k1", "k2"]).select(
        "doc_id", "p1", "p2", F.col("first.doc_id").alias("class_id"), F.col("least.doc_id").alias("group_id"),
        ((F.col("p1") == F.col("least.p1")) & (F.col("p2") == F.col("least.p2"))).alias("kept"))
    alone = sketch.where("n_words = 0").select(
        "doc_id", "p1", "p2", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("group_id"), F.lit(True).alias("kept"))
    return grouped.union(alone)


def near_copies(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id, group_id, kept: one row per input row.

    ``class_id`` is the least doc_id with the same sequence of words, ``group_id`` the least doc_id of the group that
    links of similarity ``similarity`` or more between five-word shingle sets join; ``kept`` marks the group's one
    remaining document. A document is a doc_id with a text: rows that share both are one and share all values, rows that
    share a doc_id only are compared like any others. Rows without a doc_id are documents too; they come behind all others, so that
    a group's ids are null only if none of its rows has one. Texts without a word (empty, null) are groups of their
    own. An empty table gives an empty table.

    Buckets never become pairs as a whole: every member is compared with the bucket's least document; members that are
    then still in different components are compared directly in buckets of up to ``PAIRED`` members, and by
    the heads of their ordered shingle lists, which misses no pair, in larger ones.
    """
    p1, p2 = X.row_prints()
    return _grouped(docs.select("doc_id", p1.alias("p1"), p2.alias("p2"), "text"), similarity).drop("p1", "p2")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, with their columns, of one document of each group, each document once.

    Of rows that agree in doc_id and text, the one whose other columns have the least hash stays.
    """
    names = docs.columns
    p1, p2 = X.row_prints()
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c_{i}") for i, c in enumerate(names)], p1.alias("p1"), p2.alias("p2"))
    id_, text = f"c_{names.index('doc_id')}", f"c_{names.index('text')}"
    gone = _grouped(inner.select(F.col(id_).alias("doc_id"), "p1", "p2", F.col(text).alias("text")), similarity)
    rest = inner.join(gone.where("not kept").select("p1", "p2").distinct(), ["p1", "p2"], "left_anti")
    others = [c for c, kind in inner.dtypes if c.startswith("c_") and c not in (id_, text)]
    hashed = [c for c, kind in inner.dtypes if c in others and "map<" not in kind and "variant" not in kind]
    if not others:
        rest = rest.dropDuplicates(["p1", "p2", id_, text])
    else:
        rest = rest.groupBy("p1", "p2", id_, text).agg(F.min_by(F.struct(*others), F.xxhash64(*hashed) if hashed else F.lit(0)).alias("o"))
    return rest.select(*[F.col(c if c in (id_, text) else f"o.{c}").alias(n) for n, c in zip(names, [f"c_{i}" for i in range(len(names))], strict=True)])
