"""Merkle dataset manifest: digests of all rows under one root, and a proof per row checked by a recursive query.

The levels of the trees are built bottom up by grouping runs of 16 nodes and stored as parent-linked node rows. A Spark
recursive query then climbs from every run of leaves to the root and notes the nodes it passes. Their members join once,
after the climb; each leaf's (possibly tampered) digest is folded into one parent after the other, and the siblings are its proof.
Digests are stored and moved as 32 bytes and hashed as hex text.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coinloft.llm.licences import LOWER, UPPER
from coinloft.session import cut_lineage

RUN = 16  # children of a node
CLIMBERS = 4096  # climbing rows that meet one copy of a node
TAMPERED = 5  # every document whose key's CRC this divides is tampered with in the check


def encoded(c: Column) -> Column:
    """``-`` for null, else the value's length in UTF-8 bytes, a colon and the value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _hexed(digests: str) -> str:
    """SQL: an array of digests as one hex text."""
    return f"array_join(transform({digests}, d -> lower(hex(d))), '')"


def positions(rows: DataFrame, tree: str, order: list[str], purpose: str) -> DataFrame:
    """``rows`` with ``pos``, from 0 and gapless within each ``tree``, ascending by ``order``, and the tree's ``size``.

    Rows are dealt into ranges of (tree, order), so a tree of any share of the rows is spread. A row's number in its range, less
    that of the tree's first row there, plus the tree's rows in earlier ranges, is its position. ``order`` must be unique.
    """
    placed = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order).withColumn("at", F.monotonically_increasing_id())
    placed = cut_lineage(placed.withColumn("part", F.shiftright("at", 33)), purpose)
    part = placed.groupBy(tree, "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    # one row per tree and range it lies in
    before = Window.partitionBy(tree).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    part = part.withColumns({"base": F.coalesce(F.sum("n").over(before), F.lit(0)), "size": F.sum("n").over(Window.partitionBy(tree))})
    part = cut_lineage(part.drop("n"), "ranges")  # of known size: where it is small, the rows are not shuffled to meet it
    return placed.join(part, [tree, "part"]).withColumn("pos", F.col("base") + F.col("at") - F.col("first")).drop("part", "at", "first", "base")


def _node(level: Column, pos: Column) -> Column:
    return F.concat_ws("/", level, pos, "tree")


def _levels(nodes: DataFrame) -> DataFrame:
    """All inner nodes above ``nodes`` (tree, level, pos, size: nodes of the tree on this level, digest, weight).

    Result: node, tree, level, pos, size, digest, members (the children's digests, one after the other), weight (sum of the children's).
    One job a level, each a sixteenth of the last.
    """
    out = None
    while True:
        many = nodes.where("size > 1")
        if many.isEmpty():
            break
        child = F.array_sort(F.collect_list(F.struct("pos", "digest")))
        up = many.groupBy("tree", F.expr(f"pos div {RUN}").alias("pos"), "size", "level").agg(child.alias("c"), F.sum("weight").alias("weight"))
        up = up.select("tree", (F.col("level") + 1).alias("level"), "pos", F.expr(f"(size + {RUN - 1}) div {RUN}").alias("size"), F.expr(_hexed("c.digest")).alias("members"), "weight")
        up = up.withColumns({"digest": F.unhex(digest(F.col("members"))), "members": F.unhex("members"), "node": _node(F.col("level"), F.col("pos"))})
        nodes = cut_lineage(up, "tree-level")
        out = nodes if out is None else out.union(nodes)
    return out


def leaves(docs: DataFrame) -> DataFrame:
    """source, doc_id, leaf, and altered: the leaf of the tampered row, else the same leaf."""
    def of(text: Column) -> Column:
        return digest(*[encoded(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], encoded(text))

    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0, F.lit(False))
    lowered = of(F.translate("text", UPPER, LOWER))
    return docs.select("source", "doc_id", of(F.col("text")).alias("leaf"), F.when(tampered, lowered).otherwise(of(F.col("text"))).alias("altered"))


def trees(leaf: DataFrame) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """(runs, links, nodes) over ``leaf`` (source, doc_id, leaf, altered); only runs if there is no node above them.

    ``runs``: each run of up to 16 leaves: run, kids (doc_id, leaf, altered: null where it is the same leaf), alone (no other leaf in the
    source), digest, subroot (set if the run is its source's root). ``links``: run, up, place, salts. ``nodes``: node, members, digest, subroot,
    up, place, salts, weight for every node above. ``up`` is the parent's key (null at the root), ``place`` the place among its children,
    ``salts`` in how many copies the climb finds it.
    """
    altered = F.when(F.col("altered") != F.col("leaf"), F.unhex("altered"))
    rows = leaf.select(encoded(F.col("source")).alias("tree"), "doc_id", F.unhex("leaf").alias("leaf"), altered.alias("altered"))
    rows = cut_lineage(rows.withColumn("seq", F.monotonically_increasing_id()), "leaves")
    placed = positions(rows, "tree", ["doc_id", "leaf", "seq"], "placed-leaves")
    kid = F.array_sort(F.collect_list(F.struct("pos", "doc_id", "leaf", "altered")))
    runs = placed.groupBy("tree", "size", F.expr(f"pos div {RUN}").alias("pos")).agg(kid.alias("kids"))
    runs = runs.withColumn("alone", F.col("size") == 1)
    runs = runs.withColumn("digest", F.when(F.col("alone"), F.col("kids.leaf")[0]).otherwise(F.unhex(digest(F.expr(_hexed("kids.leaf"))))))
    runs = runs.withColumns({"size": F.expr(f"(size + {RUN - 1}) div {RUN}"), "level": F.lit(1), "run": _node(F.lit(1), F.col("pos"))})
    runs = cut_lineage(runs.withColumn("weight", F.lit(1).cast("long")), "leaf-runs")

    base = runs.select("tree", "level", "pos", "size", "digest", "weight")
    inner = _levels(base)
    tops = base.where("size = 1") if inner is None else base.where("size = 1").union(inner.where("size = 1").select(*base.columns))
    named = cut_lineage(tops.withColumnRenamed("tree", "under"), "subroots")
    # the top tree's name is no encoded source; null sources come first, others by their bytes
    order = named.select(F.lit("^").alias("tree"), (F.col("under") != "-").alias("named"), F.expr("if(under = '-', '', substring(under, instr(under, ':') + 1))").alias("source"), "under", "digest", "weight")
    top = cut_lineage(positions(order, "tree", ["named", "source", "under"], "placed-subroots").withColumn("level", F.lit(0)), "top-leaves")
    upper = _levels(top.select("tree", "level", "pos", "size", "digest", "weight"))

    own = runs.select("run", "kids", "alone", "digest", F.when(F.col("size") == 1, F.col("digest")).alias("subroot"))
    every = [x for x in (inner, upper) if x is not None]
    if not every:  # one source of at most 16 documents, or none
        return own, None, None
    stored = every[0]
    for x in every[1:]:
        stored = stored.union(x)

    salts = F.ceil(F.col("weight") / CLIMBERS).cast("long")
    weights = stored.select(F.col("node").alias("up"), salts.alias("salts"))
    links = top.select(F.col("under").alias("tree"), F.when(F.col("size") > 1, _node(F.lit(1), F.expr(f"pos div {RUN}"))).alias("up"), (F.col("pos") % RUN).alias("place"))

    def linked(rows: DataFrame) -> DataFrame:
        """With up, place, salts and subroot: within the tree by position, from a subroot into the top tree."""
        inside = rows.where("size > 1 or tree = '^'").withColumns({
            "up": F.when(F.col("size") > 1, _node(F.col("level") + 1, F.expr(f"pos div {RUN}"))), "place": F.col("pos") % RUN, "subroot": F.lit(None).cast("binary")})
        roots = rows.where("size = 1 and tree <> '^'").join(links, "tree").withColumn("subroot", F.col("digest"))
        return inside.unionByName(roots).join(weights, "up", "left")

    low = linked(runs.select("run", "tree", "level", "pos", "size", "digest"))
    return own, low.select("run", "up", "place", "salts"), linked(stored).select("node", "members", "digest", "subroot", "up", "place", "salts", "weight")


@contextmanager
def _unlimited(spark: SparkSession):
    """Recursive queries stop at a million rows by default; a climb has a row per run of leaves and level."""
    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def climb(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """run, way (step, place, others: the siblings' digests, one after the other; at every node above the run), subroot (null if it is the run), root.

    The 16 leaves of a run share their way up from it, so they climb as one row, which holds no more than where it is. A
    node that many rows pass is found in several copies, ``CLIMBERS`` rows each, so no key grows with the tree.
    """
    spark = links.sparkSession
    start = links.where("up IS NOT NULL").select("run", F.expr("concat(up, '#', pmod(xxhash64(run), salts))").alias("up"), "place")
    copies = nodes.withColumn("copy", F.explode(F.expr(f"sequence(0L, ceil(weight / {CLIMBERS}) - 1)")))
    copies = copies.select(F.concat_ws("#", "node", "copy").alias("node"), "members", "digest", "subroot", "up", "place", "salts")
    start, copies = cut_lineage(start, "climb-start"), cut_lineage(copies, "nodes")
    with _unlimited(spark):
        done = spark.sql("""
            WITH RECURSIVE climb AS (
              SELECT run, 1 AS step, up, place FROM {start}
              UNION ALL
              SELECT c.run, c.step + 1, concat(n.up, '#', pmod(xxhash64(c.run), n.salts)), n.place
              FROM climb c JOIN {nodes} n ON c.up = n.node)
            SELECT run, step, up, place FROM climb""", start=start, nodes=copies.where("up IS NOT NULL").select("node", "up", "place", "salts"))
        done = cut_lineage(done, "climbed")
    # the first digest of a node's members is at byte 1
    others = F.expr("concat(substring(members, 1, int(32 * c.place)), substring(members, int(32 * c.place + 33)))")
    passed = done.alias("c").join(copies.alias("n"), F.col("c.up") == F.col("n.node")).select(
        "run", F.struct("step", F.col("c.place").cast("int").alias("place"), others.alias("others")).alias("at"), "subroot", F.expr("if(n.up IS NULL, digest, NULL)").alias("root"))
    return passed.groupBy("run").agg(F.collect_list("at").alias("way"), F.max("subroot").alias("subroot"), F.max("root").alias("root"))


def verified(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: one row per row of ``docs``.

    Rows are ordered within a source by doc_id (null first), rows of one doc_id by their leaf; equal rows have equal leaves, so their
    order does not matter. A null doc_id is never tampered with. ``verified`` tells whether the fold of the altered leaf with
    the original siblings gives the root. Columns other than the five digested ones are ignored; an empty table gives none.
    """
    runs, links, nodes = trees(leaves(docs.select("doc_id", "source", "lang", "n_chars", "text")))
    if links is None:
        none = {"way": "array<struct<step:int,place:int,others:binary>>", "above": "binary", "root": "binary"}
        each = runs.withColumns({c: F.lit(None).cast(t) for c, t in none.items()})
    else:
        each = runs.join(climb(links, nodes).withColumnRenamed("subroot", "above"), "run", "left")
    hexed = lambda *c: F.lower(F.hex(F.coalesce(*c)))
    each = each.select(
        hexed("subroot", "above").alias("subroot"), hexed("root", "digest").alias("root"), "alone",
        F.expr("transform(kids, k -> struct(k.doc_id, lower(hex(k.leaf)) as leaf, lower(hex(coalesce(k.altered, k.leaf))) as altered))").alias("kids"),
        F.expr("transform(array_sort(coalesce(way, array())), s -> struct(s.place, lower(hex(s.others)) as others))").alias("way"))
    # both texts around a kid's leaf in its run, and each step's fold of what came from below with the siblings there
    each = each.withColumns({"proof": F.array_join("way.others", ""), "kids": F.expr("""
        transform(kids, (k, p) -> struct(k.doc_id, k.leaf, k.altered,
          array_join(slice(kids.leaf, 1, p), '') as before, array_join(slice(kids.leaf, p + 2, size(kids)), '') as after))""")})
    each = each.select("subroot", "root", "way", "proof", F.explode(F.expr("""
        transform(kids, k -> struct(k.doc_id, k.leaf, sha2(concat(k.before, k.after, proof), 256) as proof_sha256,
          if(alone, k.altered, sha2(concat(k.before, k.altered, k.after), 256)) as first))""")).alias("k"))
    folded = F.expr("aggregate(way, k.first, (f, s) -> sha2(concat(substring(s.others, 1, 64 * s.place), f, substring(s.others, 64 * s.place + 1)), 256))")
    each = each.select("k.doc_id", "k.leaf", "subroot", "root", "k.proof_sha256", folded.alias("folded_root"))
    return each.withColumn("verified", F.col("folded_root") == F.col("root"))


def twin() -> str:
    """The same rows in SQL, every leaf climbing by itself."""
    def enc(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join([enc("doc_id"), enc("source"), enc("lang"), enc("n_chars"), enc(text)]) + ")"

    step = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
    fold = "sha256(array_to_string(list_concat(list_concat(r.members[1 : c.pos % 16], [c.h]), r.members[c.pos % 16 + 2 :]), ''))"
    rest = "array_to_string(list_concat(r.members[1 : c.pos % 16], r.members[c.pos % 16 + 2 :]), '')"

    def levels(name: str, start: str) -> str:
        return f"""{name} AS ({start} UNION ALL
          SELECT tree, level + 1, pos // 16, (size + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos)) FROM {name} WHERE size > 1 GROUP BY tree, level, pos // 16, size),
        {name}_runs AS (SELECT tree, level, pos // 16 AS up, list(digest ORDER BY pos) AS members FROM {name} WHERE size > 1 GROUP BY ALL)"""

    def climbing(name: str, over: str, start: str) -> str:
        return f"""{name} AS ({start} UNION ALL
          SELECT c.id, c.tree, c.level + 1, c.pos // 16, {fold}, c.proof || {rest}
          FROM {name} c JOIN {over}_runs r ON r.tree = c.tree AND r.level = c.level AND r.up = c.pos // 16)"""

    return f"""
    WITH RECURSIVE bytes(n, c) AS (SELECT i, i FROM range(256) t(i)),
    crc_table AS (SELECT list(v ORDER BY n) AS t FROM (SELECT n, list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: {step}) AS v FROM bytes)),
    docs AS (SELECT *, row_number() OVER () AS id FROM documents),
    crcs AS (SELECT id, xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(CAST(doc_id AS VARCHAR)[i]) AS BIGINT))),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc FROM docs, crc_table),
    leaf AS (SELECT id, doc_id, source, {enc('source')} AS tree, {leaf('text')} AS leaf,
        CASE WHEN crc % {TAMPERED} = 0 THEN {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {leaf('text')} END AS altered FROM docs JOIN crcs USING (id)),
    placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS size FROM leaf),
    {levels('low', 'SELECT tree, 0 AS level, pos, size, leaf AS digest FROM placed')},
    tops AS (SELECT tree AS under, source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS size
        FROM low JOIN (SELECT DISTINCT tree, source FROM leaf) USING (tree) WHERE size = 1),
    {levels('high', "SELECT '^' AS tree, 0 AS level, pos, size, subroot AS digest FROM tops")},
    {climbing('up', 'low', "SELECT id, tree, 0 AS level, pos, altered AS h, '' AS proof FROM placed")},
    above AS (SELECT u.id, u.h, u.proof, t.pos, t.subroot FROM up u JOIN (SELECT id, max(level) AS level FROM up GROUP BY id) USING (id, level) JOIN tops t ON t.under = u.tree),
    {climbing('over_', 'high', "SELECT id, '^' AS tree, 0 AS level, pos, h, proof FROM above")},
    ended AS (SELECT o.id, o.h, o.proof FROM over_ o JOIN (SELECT id, max(level) AS level FROM over_ GROUP BY id) USING (id, level)),
    root AS (SELECT digest AS root FROM high WHERE size = 1)
    SELECT p.doc_id, p.leaf, a.subroot, root.root, sha256(e.proof) AS proof_sha256, e.h AS folded_root, e.h = root.root AS verified
    FROM placed p JOIN above a USING (id) JOIN ended e USING (id), root"""
