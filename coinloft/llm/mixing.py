"""Mixing sources to target weights: equal-token blocks apportioned by highest quotients (Sainte-Laguë)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coinloft.session import cut_lineage

WEIGHTS = (3, 1, 2)  # repeating, over the sources in code point order, null last
SHARE = 1.5  # of all words
CAP = 2  # times a source's words
BLOCKS = 65536  # about so many equal-token blocks in the whole mix
SHARDS = 8
SEED = "mix-1"
BUCKETS = 3  # hex digits of the order key that split a source's running sums


def n_words(text):
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """``sources(source, source_size)`` with place, weight, target, total.

    Every source gets words in proportion to its weight, but at most ``cap`` times its size; what is above goes to the
    others by weight, until none is above. Sorted by size over weight the capped sources come first, so one
    pass of running sums over the source table (one row per source) gives the level. No source: no row.
    """
    whole = W.partitionBy(F.lit(0))
    by_name, by_ratio = whole.orderBy(F.col("source").asc_nulls_last()), whole.orderBy("ratio", "place")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    t = sources.withColumn("place", F.row_number().over(by_name) - 1).withColumn("weight", weight)
    t = t.withColumn("total", share * F.sum("source_size").over(whole)).withColumn("most", cap * F.col("source_size"))
    t = t.withColumn("ratio", F.col("most") / F.col("weight"))
    before = F.coalesce(F.sum("most").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    t = t.withColumn("level", (F.col("total") - before) / F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing)))
    t = t.withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "place", "level"))).over(whole)["level"])
    target = F.least(F.col("most").cast("double"), F.coalesce(F.col("weight") * F.col("level"), F.col("most").cast("double")))
    return t.select("source", "source_size", "place", "weight", target.alias("target"), "total")


def quotas(wanted: DataFrame, shards: int = SHARDS, blocks: int = BLOCKS) -> DataFrame:
    """source, shard, quota, drawn_before, block: whole blocks of ``block`` words that each shard takes of each source.

    Sainte-Laguë: seat k of a source has the quotient target / (2 k - 1), the highest quotients win, ties go to the earlier
    source. Its results for a growing number of seats only grow, so shard h gets the difference between the seats
    for h and for h - 1 shares of the blocks. Seats that a source wins for certain are counted at once; only the few
    around its exact share are ranked, about three rows per source and shard.
    """
    spark = wanted.sparkSession
    t = wanted.withColumn("block", F.greatest(F.lit(1), F.floor(F.col("total") / blocks)).cast("long"))
    t = t.withColumn("all_seats", F.floor(F.col("total") / F.col("block") + 0.5).cast("long"))
    t = t.withColumn("n", F.count("*").over(W.partitionBy(F.lit(0))))
    t = t.withColumn("shard", F.explode(F.sequence(F.lit(1), F.lit(shards))))
    t = t.withColumn("seats", F.floor(F.col("all_seats") * F.col("shard") / shards).cast("long"))
    exact = F.when(F.col("total") > 0, F.col("seats") * F.col("target") / F.col("total")).otherwise(0.0)
    # all seats together move a source's share by n / (2 seats) of itself at most
    slack = exact * F.col("n") / (2 * F.greatest(F.col("seats"), F.lit(1)))
    t = t.withColumn("sure", F.greatest(F.lit(0), F.floor(exact - slack - 1)).cast("long"))
    t = t.withColumn("most", F.ceil(exact + slack + 1).cast("long"))
    t = t.withColumn("left", F.col("seats") - F.sum("sure").over(W.partitionBy("shard")))
    t = t.withColumn("k", F.explode(F.sequence(F.col("sure") + 1, F.greatest("most", F.col("sure") + 1))))
    rank = F.row_number().over(W.partitionBy("shard").orderBy((F.col("target") / (2 * F.col("k") - 1)).desc(), "place", "k"))
    won = F.sum(F.when((F.col("rank") <= F.col("left")) & (F.col("target") > 0), 1).otherwise(0))
    t = t.withColumn("rank", rank).groupBy("source", "place", "shard", "block").agg((F.first("sure") + won).alias("upto"))
    before = F.coalesce(F.lag("upto").over(W.partitionBy("place").orderBy("shard")), F.lit(0))
    return t.select("source", "shard", "block", before.alias("drawn_before"), (F.col("upto") - before).alias("quota"))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP, shards: int = SHARDS,
    blocks: int = BLOCKS, seed: str = SEED,
) -> DataFrame:
    """doc_id, size, source_size, target, taken, source, first, drawn: one row per input row.

    A source's documents stand in a line in the order of a seeded hash; the line is cut into blocks of equal
    length, and its blocks are drawn from the start, going round again where the quota exceeds the line. ``taken``
    counts the drawn words inside the document, repeats included: no more than ``cap`` times its size. A null or
    empty text has size 0 and nothing is taken of it. Null sources are one source. A null doc_id sorts as the
    empty string. Repeated rows follow each other in the line. Running sums are formed within 4096 hash ranges of
    each source, so that no task holds a whole source. Reruns agree.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), key.alias("h"))
    sized = cut_lineage(sized.withColumn("bucket", F.substring("h", 1, BUCKETS)), "sizes")
    sums = cut_lineage(sized.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "bucket-sizes")
    wanted = cut_lineage(targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, cap), "targets")
    drawn = quotas(wanted, shards, blocks).groupBy("source").agg((F.sum("quota") * F.max("block")).alias("drawn"))
    per_source = wanted.alias("t").join(drawn.alias("d"), F.col("t.source").eqNullSafe(F.col("d.source"))).select(
        "t.source", "source_size", "target", F.least("drawn", cap * F.col("source_size")).alias("drawn"))
    starts = sums.withColumn("start", F.sum("words").over(W.partitionBy("source").orderBy("bucket")) - F.col("words"))
    starts = starts.alias("s").join(per_source.alias("p"), F.col("s.source").eqNullSafe(F.col("p.source"))).select(
        F.col("s.source").alias("of"), F.col("bucket").alias("at"), "start", "source_size", "target", "drawn")
    line = W.partitionBy("source", "bucket").orderBy("h", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    placed = sized.withColumn("run", F.sum("size").over(line) - F.col("size"))
    placed = placed.join(starts, placed["source"].eqNullSafe(starts["of"]) & (placed["bucket"] == starts["at"]))
    first = F.col("start") + F.col("run")
    whole = F.when(F.col("source_size") > 0, F.expr("drawn div source_size")).otherwise(0)
    rest = F.when(F.col("source_size") > 0, F.col("drawn") % F.col("source_size")).otherwise(0)
    taken = whole * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - first))
    return placed.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "source", first.alias("first"), "drawn")


def pieces(mixed: DataFrame, quota: DataFrame) -> DataFrame:
    """doc_id, shard, round, from_word, n_words: what each shard takes of each document, from ``mix`` and ``quotas``.

    The shard's blocks are a stretch of the source's line; a document meets it at most once in each round.
    """
    q = quota.where("quota > 0").select(F.col("source").alias("of"), "shard", (F.col("drawn_before") * F.col("block")).alias("lo"),
                                        ((F.col("drawn_before") + F.col("quota")) * F.col("block")).alias("hi"))
    m = mixed.where("size > 0").withColumn("round", F.explode(F.expr("sequence(0L, greatest(0L, (drawn - 1) div source_size))")))
    m = m.withColumn("at", F.col("round") * F.col("source_size") + F.col("first"))
    j = m.join(q, m["source"].eqNullSafe(q["of"]) & (F.col("at") < F.least("hi", "drawn")) & (F.col("at") + F.col("size") > F.col("lo")))
    lo = F.greatest("lo", "at")
    hi = F.least("hi", "drawn", F.col("at") + F.col("size"))
    return j.select("doc_id", "shard", "round", (lo - F.col("at")).alias("from_word"), (hi - lo).alias("n_words")).where("n_words > 0")


def mixed_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with their columns, each as often as the mix takes it, to the nearest whole number.

    Only the document at the end of a source's drawn stretch is taken in part, and so rounded. Texts without words go.
    """
    copies = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    names = docs.columns
    count = mix(docs.select("doc_id", "source", "text")).where("size > 0").groupBy("doc_id").agg(F.max(copies).alias("n")).where("n > 0")
    each = docs.select(*[F.col(f"`{c}`").alias(f"c_{i}") for i, c in enumerate(names)])
    each = each.join(count, F.col(f"c_{names.index('doc_id')}").eqNullSafe(F.col("doc_id"))).withColumn("copy", F.explode(F.expr("sequence(1, n)")))
    return each.select(*[F.col(f"c_{i}").alias(c) for i, c in enumerate(names)])


def twin() -> str:
    """The table of ``mix`` in SQL. Highest quotients are ranked in full, one row per possible block."""
    w = ", ".join(map(str, WEIGHTS))
    return f"""
    WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
        md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
    s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place FROM d GROUP BY source),
    t AS (SELECT *, list_extract([{w}], CAST(place % {len(WEIGHTS)} AS INTEGER) + 1) AS weight, {CAP} * source_size AS most,
        {SHARE}::DOUBLE * sum(source_size) OVER () AS total FROM s),
    r AS (SELECT *, most::DOUBLE / weight AS ratio FROM t),
    l AS (SELECT *, (total - coalesce(sum(most) OVER (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
        / sum(weight) OVER (ORDER BY ratio, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level FROM r),
    v AS (SELECT *, (SELECT level FROM l WHERE level <= ratio ORDER BY ratio, place LIMIT 1) AS water FROM l),
    g AS (SELECT *, least(most::DOUBLE, coalesce(weight * water, most::DOUBLE)) AS target, greatest(1, CAST(floor(total / {BLOCKS}) AS BIGINT)) AS block FROM v),
    q AS (SELECT g.*, k, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, place, k) AS seat, CAST(floor(total / block + 0.5) AS BIGINT) AS seats
        FROM g, unnest(range(1, CAST(ceil(target / block * 1.01) AS BIGINT) + 3)) AS u(k) WHERE target > 0),
    a AS (SELECT place, count(*) AS quota FROM q WHERE seat <= seats GROUP BY place),
    f AS (SELECT g.source, source_size, target, least(coalesce(quota, 0) * block, {CAP} * source_size) AS drawn FROM g LEFT JOIN a USING (place)),
    n AS (SELECT doc_id, source, size, CAST(sum(size) OVER (PARTITION BY source ORDER BY h, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - size AS first FROM d)
    SELECT doc_id, size, source_size, target,
      CAST(CASE WHEN source_size > 0 THEN (drawn // source_size) * size + greatest(0, least(size, drawn % source_size - first)) ELSE 0 END AS BIGINT) AS taken
    FROM n JOIN f ON n.source IS NOT DISTINCT FROM f.source"""
