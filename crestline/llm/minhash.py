"""Near-duplicate classes by circulant MinHash and exact Jaccard on full shingle sets.

Two permutations make all coordinates of a signature: one scatters the shingles over ``DOMAIN``
places, the other, shifted by k places in a circle, gives coordinate k, whose minimum over the
set is kept.  Coordinates are banded ``ROWS`` at a time; two sets of similarity 0.8 share none of
the ``BANDS`` bands with probability (1 - 0.8**4)**32 < 5e-8.

Documents with equal sets are one node.  Nodes in a common bucket are candidates, and only the
connection between them matters, so pairs are not listed: first each node is verified
against the one partner it shares most buckets with, among the least node of each of its buckets;
then against the least nodes of the buckets that still hold several components; and for the
buckets where that leaves several, every node outside the bucket's largest component is
verified against those nodes of other components that share a shingle with it among the rarest
of both, which all similar enough ones do.  Verification intersects whole sets.  Nodes that are
connected already need no further pair, so the classes are those of all links.  Each round goes on from
the components of the one before, and most rounds change little.

Components are found by alternating large-star and small-star steps over tables in the shared
folder; nothing of documents, links or components goes through the driver.

Defined cases: null or empty text, or text without words, has an empty set, is linked with
nothing and keeps itself; rows repeated with one id are one document of its class; a null id is
never the class id, and its row is not kept if the class has another.

Texts are read whole, however long; only the named columns are read, whatever others are called;
``keep_one`` returns all columns and picks names of its own that the table does not have.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crestline.llm.common import fresh, materialize, read_table, release, small_batches
from crestline.llm.shingles import shingle_sets
from crestline.llm.spans import mix64

DOMAIN = 1 << 20
BANDS = 32
ROWS = 4
THRESHOLD = 80  # percent
WORDS = 16  # of 64 bits in a parity map
WIDTH = 5


@cache
def _circle() -> np.ndarray:
    """The second permutation, with its first places again at the end; row d starts at place d."""
    k = BANDS * ROWS
    order = np.random.Generator(np.random.PCG64(7)).permutation(DOMAIN).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([order, order[:k]]), k)


def signature(shingles: np.ndarray) -> np.ndarray:
    """All coordinates of a non-empty set."""
    # The first permutation: a bijection of the hash space, cut to the domain.
    places = np.unique((mix64(shingles + np.uint64(0x5851F42D4C957F2D)) >> np.uint64(44)).astype(np.int64))
    low = np.full(BANDS * ROWS, DOMAIN, np.uint32)
    for at in range(0, len(places), 4096):
        np.minimum(low, _circle()[places[at : at + 4096]].min(0), out=low)
    return low


def bands(shingles: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key per band."""
    low = signature(shingles).astype(np.uint64).reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for r in range(ROWS):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + low[:, r])
    return key.view(np.int64)


def parity(shingles: np.ndarray) -> np.ndarray:
    """64 * WORDS bits, each whether an odd number of shingles falls on it."""
    bits = np.bincount((shingles % np.uint64(64 * WORDS)).astype(np.int64), minlength=64 * WORDS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def node_of(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def sketches(docs: DataFrame, *, key: str, text: str, width: int) -> DataFrame:
    """key, mark, set size, node (a hash of the whole set) and bucket keys of every row."""
    small_batches(docs.sparkSession)

    def sketch(batches):
        for b in batches:
            n, node, found = [], [], []
            for s in shingle_sets(b.column(2).to_pylist(), width):
                n.append(len(s))
                node.append(node_of(s) if len(s) else None)
                found.append(bands(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                names=["key", "mark", "n", "node", "bands"],
            )

    named = docs.select(F.col(key).cast("long").alias("key"), _mark(key, text).alias("mark"), F.col(text).alias("text"))
    return named.mapInArrow(sketch, "key long, mark long, n long, node long, bands array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, *, key: str, text: str, width: int) -> DataFrame:
    """node and whole set of the wanted nodes (key, node), from the texts of their documents."""

    def make(batches):
        for b in batches:
            node, out = [], []
            for want, s in zip(b.column(0).to_pylist(), shingle_sets(b.column(1).to_pylist(), width)):
                if len(s) and node_of(s) == want:  # one id may have several texts
                    node.append(want)
                    out.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(out, pa.binary())], names=["node", "shingles"])

    named = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("text"))
    found = named.join(wanted, F.col("k").eqNullSafe(F.col("key"))).select("node", "text").mapInArrow(make, "node long, shingles binary")
    return found.groupBy("node").agg(F.first("shingles").alias("shingles"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough, with their similarity in percent."""

    def compare(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                small, large = min(len(x), len(y)), max(len(x), len(y))
                if 100 * small < percent * large:
                    keep.append(False)
                    continue
                both = np.intersect1d(x, y, assume_unique=True).size
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column("a").filter(pa.array(keep, pa.bool_())), b.column("b").filter(pa.array(keep, pa.bool_()))], names=["a", "b"])

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return materialize(
        pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(compare, "a long, b long"), "minhash-links"
    )


def _prefix_pairs(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes of different roots that can be similar enough, one of them ``few``.

    All shingles are put in one order, rare ones first.  Two sets of n and m shingles, similar
    enough, share one of the first n - ceil(t n) + 1 of the one and m - ceil(t m) + 1 of the
    other.  From the first shared one on, enough must be left of both.  A set that
    differs from all others begins with shingles of its own, which meet none.  And the bits that the
    parities of their shingles differ in must leave room for the similarity, which drops most
    pairs of a group of copies that differ too much before they are rows of the join.
    """

    def spell(batches):
        for b in batches:
            for node, root, few, raw in zip(*(b.column(c).to_pylist() for c in ("node", "root", "few", "shingles"))):
                own = np.frombuffer(raw, np.int64)
                n = len(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, node)), pa.array(np.full(n, root)), pa.array(np.full(n, bool(few))), pa.array(own)],
                    names=["node", "root", "few", "shingle"],
                )

    def fold(batches):
        for b in batches:
            bits = [parity(np.frombuffer(raw, np.uint64)) for raw in b.column("shingles").to_pylist()]
            table = np.stack(bits) if bits else np.zeros((0, WORDS), np.int64)
            yield pa.RecordBatch.from_arrays([b.column("node"), *[pa.array(c) for c in table.T]], names=["node", *words])

    words = [f"w{i}" for i in range(WORDS)]
    spelt = nodes.join(sets, "node").select("node", "root", "few", "shingles").mapInArrow(spell, "node long, root long, few boolean, shingle long")
    spelt = materialize(spelt, "minhash-spelt")
    folded = sets.join(nodes.select("node"), "node", "left_semi").mapInArrow(fold, ", ".join(["node long", *[f"{w} long" for w in words]]))
    often = spelt.groupBy("shingle").agg(F.count(F.lit(1)).alias("often"))
    placed = spelt.join(often, "shingle").groupBy("node", "root", "few").agg(
        F.sort_array(F.collect_list(F.struct("often", "shingle"))).alias("all")
    )
    n = F.size("all")
    length = n - F.ceil(n * F.lit(percent) / 100).cast("int") + 1
    first = placed.select("node", "root", "few", n.alias("n"), F.posexplode(F.slice("all", F.lit(1), length)).alias("i", "one")).where("one.often > 1")
    first = first.select("node", "root", "few", "n", "i", F.col("one.shingle").alias("shingle")).join(folded, "node")
    first = materialize(first, "minhash-prefixes")
    x, y = first.where("few").alias("x"), first.alias("y")
    # What is left from the first shared shingle on must be enough for the similarity.
    most = F.least(F.col("x.n") - F.col("x.i"), F.col("y.n") - F.col("y.i"))
    fits = most * (100 + percent) >= (F.col("x.n") + F.col("y.n")) * percent
    # Bits that differ are at most the shingles that only one of them has.
    differ = sum((F.bit_count(F.col(f"x.{w}").bitwiseXOR(F.col(f"y.{w}"))) for w in words), F.lit(0))
    alike = differ * (100 + percent) <= (F.col("x.n") + F.col("y.n")) * (100 - percent)
    once = ~F.col("y.few") | (F.col("x.node") < F.col("y.node"))
    apart = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.root") != F.col("y.root"))
    met = x.join(y, apart & fits & once & alike).select(
        F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"),
        (F.col("x.n") + F.col("y.n")).alias("both"), most.alias("most"),
    )
    # Shared so far, and what is left after the last of them, bounds what two sets can share.
    counted = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"), F.min("most").alias("left"), F.max("both").alias("both"))
    enough = (F.col("shared") + F.col("left") - 1) * (100 + percent) >= F.col("both") * percent
    return counted.where(enough).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """node, root (least node reachable) of every node with a link."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = materialize(edges, "components")
    before = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u")
        # Both links of a row at once: a union would plan all of the above twice.
        ends = moved.select("m", F.explode(F.array("u", "v")).alias("u")).where("u <> m")
        edges = materialize(ends.select("u", F.col("m").alias("v")).distinct(), "components")
        release(edges.sparkSession)
        state = _state(edges)
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())


def _more(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components with some links more: known ones go in as they are, not as the links they came from."""
    return components(roots.select(F.col("root").alias("a"), F.col("node").alias("b")).unionByName(links))


def near_duplicates(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = THRESHOLD,
) -> DataFrame:
    """key, n_shingles, component_id and kept of every row."""
    found = _classes(docs, key=key, text=text, width=width, percent=percent)
    least = F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return found.select("key", F.col("n").alias("n_shingles"), least.alias("component_id")).select(
        "*", F.coalesce(F.col("key") == F.col("component_id"), F.col("component_id").isNull()).alias("kept")
    )


def _classes(docs: DataFrame, *, key: str, text: str, width: int, percent: int) -> DataFrame:
    """key, mark, n, node, root and component_id of every row; node, root and id null for empty sets."""
    spark = docs.sparkSession
    rows = materialize(sketches(docs, key=key, text=text, width=width), "minhash-sketches")
    nodes = rows.where("node is not null").groupBy("node").agg(F.min("key").alias("key"), F.first("bands").alias("bands"))
    nodes = materialize(nodes, "minhash-nodes")
    in_bucket = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = in_bucket.groupBy("bucket").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialize(shared, "minhash-shared")
    members = materialize(in_bucket.join(shared.select("bucket", "least"), "bucket"), "minhash-buckets")
    wanted = members.select("node").distinct().join(nodes.select("node", "key"), "node")
    sets = materialize(_sets(docs, wanted, key=key, text=text, width=width), "minhash-sets")

    # One partner for each node: the least node it shares most buckets with.
    to_least = members.where("node <> least").groupBy("least", "node").agg(F.count(F.lit(1)).alias("n"))
    best = to_least.groupBy("node").agg(F.max_by("least", F.struct("n", -F.col("least"))).alias("least"))
    links = _verified(best.select(F.col("least").alias("a"), F.col("node").alias("b")), sets, percent)

    def open_buckets(roots: DataFrame) -> DataFrame:
        """Members, with their components, of the buckets that hold more than one."""
        placed = members.join(roots, "node", "left").select("bucket", "least", "node", F.coalesce("root", "node").alias("root"))
        mixed = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
        return materialize(placed.join(mixed.select("bucket"), "bucket"), "minhash-open")

    done = materialize(best.select(F.col("least").alias("a"), F.col("node").alias("b")), "minhash-pairs")
    roots = components(links)
    left = open_buckets(roots)
    release(spark)
    centre = left.where("node = least").select("bucket", F.col("root").alias("of"))
    pairs = left.join(centre, "bucket").where("root <> of").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
    pairs = materialize(pairs.join(done, ["a", "b"], "left_anti"), "minhash-pairs")
    roots = _more(roots, _verified(pairs, sets, percent))

    left = open_buckets(roots)
    release(spark)
    sizes = left.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("bucket").agg(F.max_by("root", F.struct("n", "root")).alias("main"))
    few = left.join(main, "bucket").where("root <> main").select("node").distinct().withColumn("few", F.lit(True))
    open_nodes = materialize(left.select("node", "root").distinct().join(few, "node", "left"), "minhash-open-nodes")
    rest = _prefix_pairs(open_nodes, sets, percent)
    rest = materialize(rest.join(done.unionByName(pairs), ["a", "b"], "left_anti"), "minhash-pairs")
    roots = _more(roots, _verified(rest, sets, percent))
    release(spark)
    rooted = nodes.select("node", "key").join(roots, "node", "left").select("node", "key", F.coalesce("root", "node").alias("root"))
    least = rooted.groupBy("root").agg(F.min("key").alias("component_id"))
    labelled = materialize(rooted.join(least, "root").select("node", "root", "component_id"), "minhash-labels")
    return rows.select("key", "mark", "n", "node").join(labelled, "node", "left")


def keep_one(docs: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = THRESHOLD) -> DataFrame:
    """One row of each class, whole as it is: of the least id (null last), and of its texts one by hash.

    Rows are told by id and text: an id with several texts loses none that is in a class of its own.
    Of rows equal in both the first stays.  Rows without words are in no class and all stay.
    """
    found = materialize(_classes(docs, key=key, text=text, width=width, percent=percent), "minhash-found")
    own = found.where("node is not null").groupBy("root", "key", "mark").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "mark"))
    chosen = own.groupBy("root").agg(first.alias("first")).select("root", "first.key", "first.mark", F.lit(True).alias("stays"))
    same = (F.col("o.root") == F.col("c.root")) & F.col("o.key").eqNullSafe(F.col("c.key")) & (F.col("o.mark") == F.col("c.mark"))
    judged = own.alias("o").join(chosen.alias("c"), same, "left").select("o.key", "o.mark", "o.n", F.coalesce("c.stays", F.lit(False)).alias("stays"))
    id_, mark_ = fresh(docs, "id"), fresh(docs, "mark")
    odd = judged.where("n > 1 or not stays").select(F.col("key").alias(id_), F.col("mark").alias(mark_), "stays")
    odd = materialize(odd, "minhash-odd")
    at = F.col(key).cast("long").eqNullSafe(F.col(id_)) & (_mark(key, text) == F.col(mark_))
    # The same plan at every size: whether these rows fit a broadcast depends on the data.
    single = docs.join(odd.select(id_, mark_).hint("merge"), at, "left_anti")
    many = docs.join(odd.where("stays").select(id_, mark_).hint("merge"), at, "left_semi").dropDuplicates([key, text])
    return single.unionByName(many)


def _mark(key: str, text: str):
    """What tells a row beside its id: a hash of its text."""
    return F.xxhash64(F.col(key).cast("long"), F.col(text))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, width=4).withColumnRenamed("key", "doc_id")


NEAR_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM w
), n AS (SELECT doc_id, len(s) AS n FROM s),
e AS (SELECT doc_id, unnest(s) AS g FROM s),
i AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM n UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.other
)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT doc_id, n AS n_shingles, min(other) AS component_id FROM n JOIN reach USING (doc_id) GROUP BY doc_id, n)"""
