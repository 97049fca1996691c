"""Jaccard similarity join of documents, by vertical partitioning of the global shingle order.

All shingles stand in one global order, rare ones first, which is cut into fragments. A document's set
falls into one segment per fragment. The first fragments hold the prefixes: two sets of the wanted
similarity share a shingle among the first few of each (as many as they may differ by, and one), so
only there are candidates looked for. For a candidate pair the overlap of its segments is counted in each
fragment by itself, and the partial counts are summed per pair.

The order is by document counts over all documents, in classes of an eighth of a power of two, ties by
hash. Shingles of one document are dropped as soon as that is known; most documents end there.

The result needs components, not all pairs. Sets that are equal are one node. Then, in a few rounds, each
node is compared with a few hubs of shingles that several components share, which joins groups of near
copies in a number of comparisons proportional to their members. In the last round every pair of
nodes from different components that shares a prefix shingle and whose sizes allow it is compared, so no
link that could join two components is lost.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantweave.llm import blocks as bl
from grantweave.llm.components import components
from grantweave.llm.tables import join_groups, stored

WIDTH = 4
#: percent of the union that the intersection must have
PERCENT = 85
#: fragments end at these document counts, given as 8 times their binary logarithm: 2, 4 and 16
PIVOTS = (9, 17, 33)
FRAGMENTS = len(PIVOTS) + 1
#: rounds in which a node meets hubs, before the round that compares all that is left; the bands of each, in
#: which nodes meet whose smallest shingles under this many orders are the same
STAR_ROUNDS = 2
BANDS = 8
BAND_ROWS = 5

_orders = np.random.default_rng(17).integers(1, 1 << 62, STAR_ROUNDS * BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Shingles:
    """The distinct shingles of each document of a block, document by document."""

    def __init__(self, text: bl.BlockText, width: int):
        starts = text.windows(width)
        keys, owner = text.hash_at(starts, width), text.document[starts]
        short = np.flatnonzero((text.lengths > 0) & (text.lengths < width))
        for size in range(1, width):
            some = short[text.lengths[short] == size]
            # The whole of a short text, which is no window of a longer one.
            whole = bl.mixed(text.hash_at(text.starts[some], size) + np.uint64(size))
            keys, owner = np.concatenate([keys, whole]), np.concatenate([owner, some])
        order = np.lexsort((keys, owner))
        keys, owner = keys[order], owner[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
        self.keys, self.owner = keys[new], owner[new]
        self.sizes = np.bincount(self.owner, minlength=len(text.lengths))
        self.ends = np.cumsum(self.sizes)


class Counted:
    """Short keys of a block's shingles, and how many of its documents hold each."""

    def __init__(self, shingles: Shingles, buckets: int):
        value = shingles.keys
        short = (bl.bucket_of(value, buckets) << np.uint64(32)) | (value & np.uint64(0xFFFFFFFF))
        self.keys, self.which, self.counts = np.unique(short, return_inverse=True, return_counts=True)
        self.cuts = bl.cut(self.keys >> np.uint64(32), buckets)


def _counts(table: pa.Table) -> pa.Table:
    """Answers with the class of each key's document count: 8 times its binary logarithm."""
    bucket = table.column("bucket")[0].as_py()
    sent = []
    for block, raw in zip(*(table.column(c).to_pylist() for c in ("block", "payload"))):
        n = len(raw) // 8
        sent.append((block, np.frombuffer(raw, "<u4", n), np.frombuffer(raw, "<u4", n, 4 * n)))
    found, where = np.unique(np.concatenate([k for _, k, _ in sent]), return_inverse=True)
    totals = np.bincount(where, np.concatenate([c for *_, c in sent]), len(found))
    classes = np.minimum(255, np.floor(8 * np.log2(totals))).astype(np.uint8)[where]
    out, at = [], 0
    for block, keys, _ in sent:
        out.append((bucket, block, "class", classes[at : at + len(keys)].tobytes()))
        at += len(keys)
    return bl.messages(out)


def _bands(keys: np.ndarray) -> np.ndarray:
    """One hash per band of the smallest keys under the band's orders."""
    least = np.empty(len(_orders), np.uint64)
    for k, order in enumerate(_orders):
        least[k] = (keys * order ^ (keys >> np.uint64(29))).min()
    rows = least.reshape(-1, BAND_ROWS)
    return bl.mixed(rows @ _orders[:BAND_ROWS] + np.arange(len(rows), dtype=np.uint64)).view(np.int64)


def sets(docs: DataFrame, id_column: str, text_column: str, width: int, percent: int) -> DataFrame:
    """A stored row per input row: ``node`` (grows with the id), the id, the size ``n`` of its set and ``m``
    without shingles of one document, and for rows that may have a link ``digest`` of the set, ``prefix`` and the
    ``FRAGMENTS`` segments, else nulls there."""
    docs = docs.select(id_column, F.col(text_column).cast("string").alias(text_column))
    placed, n_blocks = bl.in_blocks(docs, id_column)
    longs = pa.list_(pa.int64())
    schema = T.StructType(
        [
            T.StructField("node", T.LongType()),
            docs.schema[id_column],
            T.StructField("n", T.LongType()),
            T.StructField("m", T.LongType()),
            T.StructField("digest", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
            T.StructField("n_index", T.LongType()),
            T.StructField("prefix", T.ArrayType(T.LongType())),
            T.StructField("segments", T.ArrayType(T.ArrayType(T.LongType()))),
        ]
    )

    def shingles_of(table: pa.Table) -> tuple[bl.BlockText, Shingles]:
        text = bl.BlockText(table.column(id_column), table.column(text_column), lower=True)
        return text, Shingles(text, width)

    def send_counts(table: pa.Table) -> pa.Table:
        block = table.column(bl.BLOCK)[0].as_py()
        counted = Counted(shingles_of(table)[1], n_blocks)
        return bl.messages(
            (bucket, block, "count", counted.keys[i:j].astype("<u4").tobytes() + counted.counts[i:j].astype("<u4").tobytes())
            for bucket, i, j in counted.cuts
        )

    def order(table: pa.Table, replies: pa.Table) -> pa.Table:
        names = schema.names
        types = [pa.int64(), table.schema.field(id_column).type, pa.int64(), pa.int64(), pa.binary(), longs, pa.int64(), longs, pa.list_(longs)]
        if not table.num_rows:
            return pa.table([pa.array([], t) for t in types], names=names)
        text, shingles = shingles_of(table)
        counted = Counted(shingles, n_blocks)
        classes = np.zeros(len(counted.keys), np.uint8)
        given = dict(bl.answers(replies, "class"))
        for bucket, i, j in counted.cuts:
            classes[i:j] = np.frombuffer(given[bucket], np.uint8)
        klass = classes[counted.which]
        in_order = np.lexsort((shingles.keys, klass, shingles.owner))
        keys, klass = shingles.keys[in_order], klass[in_order]
        alone = klass == 0
        fragment = np.searchsorted(PIVOTS, klass, "right")
        digests, bands, indexed, prefixes, segments = [], [], [], [], []
        for size, end in zip(shingles.sizes.tolist(), shingles.ends.tolist()):
            begin = end - size
            head = size - -(-percent * size // 100) + 1 if size else 0
            prefix = keys[begin : begin + head][~alone[begin : begin + head]]
            if not len(prefix):
                for column in (digests, bands, indexed, prefixes, segments):
                    column.append(None)
                continue
            own = keys[begin:end].view(np.int64)
            digests.append(xxhash.xxh3_128_digest(np.sort(own).tobytes()))
            prefixes.append(prefix.view(np.int64))
            # In the smaller set of a pair, a shared shingle stands before this.
            short = size - -(-2 * percent * size // (100 + percent)) + 1
            indexed.append(int((~alone[begin : begin + short]).sum()))
            used = ~alone[begin:end]
            bands.append(_bands(keys[begin:end][used]))
            segments.append([own[used & (fragment[begin:end] == f)] for f in range(FRAGMENTS)])
        block = table.column(bl.BLOCK)[0].as_py()
        columns = [
            (block << 32) + np.arange(table.num_rows),
            table.column(id_column).take(pa.array(text.order)),
            shingles.sizes,
            shingles.sizes - np.bincount(shingles.owner[in_order][alone], minlength=table.num_rows),
            digests,
            bands,
            indexed,
            prefixes,
            segments,
        ]
        return pa.table([c if isinstance(c, pa.ChunkedArray) else pa.array(c, t) for c, t in zip(columns, types)], names=names)

    answered = bl.answer(bl.send(placed, send_counts), _counts)
    return stored(bl.receive(placed, answered, order, schema), "sets")


def _alike(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Of pairs ``a``, ``b`` those that are similar enough.

    ``parts`` has ``node``, ``n``, ``fragment`` and ``segment``. Overlaps are counted per fragment, then summed.
    """
    def side(name: str) -> DataFrame:
        return parts.select(
            F.col("node").alias(name), F.col("n").alias(f"n_{name}"), "fragment", F.col("segment").alias(f"segment_{name}")
        )

    partial = (
        pairs.join(side("a"), "a")
        .join(side("b"), ["b", "fragment"])
        .select("a", "b", "n_a", "n_b", F.size(F.array_intersect("segment_a", "segment_b")).cast("long").alias("_part"))
    )
    summed = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("_part").alias("_both"))
    return summed.filter(100 * F.col("_both") >= percent * (F.col("n_a") + F.col("n_b") - F.col("_both"))).select("a", "b")


def _fits(percent: int, a: str = "a", b: str = "b") -> Column:
    """Whether two sets can be similar enough, by their sizes with and without shingles that nobody shares."""
    n_a, n_b, most = F.col(f"n_{a}"), F.col(f"n_{b}"), F.least(f"m_{a}", f"m_{b}")
    return (100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)) & (100 * most >= percent * (n_a + n_b - most))


def _between(postings: DataFrame) -> DataFrame:
    """Postings of the tokens that more than one component holds, one of them near its front."""
    split = postings.groupBy("token").agg(
        F.min("component").alias("_least"), F.max("component").alias("_most"), F.max("index").alias("_index"), F.count(F.lit(1)).alias("_n")
    )
    split = stored(split.filter("_least < _most and _index").select("token", "_n"), "tokens")
    return stored(join_groups(postings, split, ["token"], "_n").drop("_n"), "postings")


def _hub_pairs(nodes: DataFrame, percent: int) -> DataFrame:
    """Each node with the hub of each of its bands, where that is of another component.

    ``nodes`` has ``node``, ``n``, ``m``, ``component`` and ``bands``. The hub of a band and size class is the node with
    fewest shingles of its own, so a band of any size costs one pair per node.
    """
    step = -math.log(percent / 100)
    sized = stored(
        nodes.select("node", "n", "m", "component", F.floor(F.log("n") / step).alias("_size"), F.explode("bands").alias("band")),
        "bands",
    )
    draw = F.struct(
        (F.col("n") - F.col("m")).alias("h"),
        F.col("node").alias("b"),
        F.col("component").alias("_other"),
        F.col("n").alias("n_b"),
        F.col("m").alias("m_b"),
    )
    hubs = stored(
        sized.groupBy("band", "_size").agg(F.min(draw).alias("_hub"), F.count(F.lit(1)).alias("_n")), "hubs"
    ).filter("_n > 1").select("band", "_size", "_n", "_hub.*").drop("h")
    named = join_groups(sized, hubs, ["band", "_size"], "_n").withColumnsRenamed({"node": "a", "n": "n_a", "m": "m_a"})
    found = named.filter((F.col("component") != F.col("_other")) & _fits(percent))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _all_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """Every pair of nodes from different components that shares a token and could be similar.

    On each token ``m`` is what the node's set can share if this is the first token shared: its shared shingles
    from here on. A similar pair meets on its first shared token at the latest, so no pair is lost by that.
    The smaller set has the token in the part of its prefix marked ``index``. Components meet before their nodes
    do, with the extreme sizes of their nodes on the token, so the nodes of one component never do.
    """
    def side(table: DataFrame, name: str) -> DataFrame:
        return table.select("token", *[F.col(c).alias(f"{c}_{name}") for c in table.columns if c != "token"])

    front = postings.filter("index").drop("index")
    sizes = [F.min("n").alias("n"), F.max("n").alias("_most"), F.max("m").alias("m")]
    a = side(front.groupBy("token", "component").agg(*sizes), "a")
    b = side(postings.groupBy("token", "component").agg(*sizes), "b")
    shared = F.least("m_a", "m_b")
    may = (
        (F.col("component_a") != F.col("component_b"))
        & (F.col("n_a") <= F.col("_most_b"))
        & (100 * F.col("_most_a") >= percent * F.col("n_b"))
        & (100 * shared >= percent * (F.col("n_a") + F.greatest("n_a", "n_b") - shared))
    )
    crossing = a.join(b, (a["token"] == b["token"]) & may).select(
        a["token"], "component_a", "component_b", F.col("n_b").alias("_least"), F.col("_most_b").alias("_most"), F.col("m_b").alias("_m")
    )
    # Nodes of the one side are held against the other component's extremes before its nodes are joined.
    one, n = side(front, "a"), F.col("n_a")
    common = F.least("m_a", "_m")
    still = (
        (n <= F.col("_most"))
        & (100 * n >= percent * F.col("_least"))
        & (100 * common >= percent * (n + F.greatest("n_a", "_least") - common))
    )
    same = (crossing["token"] == one["token"]) & (crossing["component_a"] == one["component_a"])
    met = crossing.join(one, same & still).select(crossing["token"], "component_b", "node_a", "n_a", "m_a")
    other = side(postings.drop("index"), "b")
    same = (met["token"] == other["token"]) & (met["component_b"] == other["component_b"])
    pairs = met.join(other, same & _fits(percent) & (F.col("n_a") <= F.col("n_b")))
    return pairs.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def jaccard_components(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
) -> DataFrame:
    """For every row its id, ``n_shingles``, ``component_id`` and ``kept``, true for one row of each component.

    Words are runs of characters other than the six white-space ones, A-Z lower-cased; shingles are the
    distinct windows of ``width`` words, or the whole of a shorter text. Rows link if at least ``percent``
    of the union of their sets is common; a component's id is the smallest id in it. Null and empty
    texts have an empty set and no links. Rows that repeat an id are documents of their own; null ids count
    as the largest. An empty table gives no rows. Other columns are not read.
    """
    table = sets(docs, id_column, text_column, width, percent)
    able = table.filter("digest is not null")
    copies = stored(
        able.groupBy("digest").agg(F.min("node").alias("rep"), F.count(F.lit(1)).alias("_n")), "copies"
    )
    links = join_groups(able.select("node", "digest"), copies, ["digest"], "_n").select(
        F.col("node").alias("a"), F.col("rep").alias("b")
    ).filter("a != b")
    reps = able.join(copies.select(F.col("rep").alias("node")), "node", "left_semi")
    parts = reps.select("node", "n", F.posexplode("segments").alias("fragment", "segment")).filter(F.size("segment") > 0)
    prefixes = reps.select("node", "n_index", F.posexplode("prefix").alias("at", "token"))
    prefixes = prefixes.select("node", "token", "at", (F.col("at") < F.col("n_index")).alias("index"))
    nodes = reps.select("node", "n", "m", F.col("node").alias("component"), "bands")
    for turn in range(STAR_ROUNDS):
        some = nodes.withColumn("bands", F.slice("bands", turn * BANDS + 1, BANDS))
        found = stored(_alike(stored(_hub_pairs(some, percent), "pairs"), parts, percent), "links")
        links = links.unionByName(found)
        nodes = _relabelled(nodes, components(links, "a", "b"))
    postings = nodes.drop("bands").join(prefixes, "node").withColumn("m", F.col("m") - F.col("at")).drop("at")
    postings = stored(postings, "postings")
    pairs = _all_pairs(_between(postings), percent)
    links = links.unionByName(stored(_alike(stored(pairs, "pairs"), parts, percent), "links"))
    labels = components(stored(links, "links"), "a", "b")
    labelled = table.select("node", id_column, "n").join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    names = table.select(F.col("node").alias("component"), F.col(id_column).alias("component_id"))
    counts = stored(labelled.groupBy("component").agg(F.count(F.lit(1)).alias("_n")).join(names, "component"), "names")
    return join_groups(labelled, counts, ["component"], "_n").select(
        id_column, F.col("n").alias("n_shingles"), "component_id", (F.col("node") == F.col("component")).alias("kept")
    )


def _relabelled(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    found = labels.withColumnRenamed("component", "_to")
    return stored(
        nodes.join(found, "node", "left").withColumn("component", F.coalesce("_to", "node")).drop("_to"), "nodes"
    )


def drop_near_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """``docs`` with one row of each component, that with the smallest id, null ids last; all columns unchanged.

    Rows are documents of their own, also if they repeat an id; of equal ids the row stored first stays. Texts
    without shingles are linked with nothing and stay. An empty table gives no rows. Ids are integers.
    """
    bl.require_integers(docs, id_column)
    own = F.col(f"`{id_column}`")
    repeated = docs.groupBy(own.alias("id")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1)
    if repeated.isEmpty():
        verdicts = stored(jaccard_components(docs, id_column, text_column, width, percent), "verdicts")
        kept = verdicts.filter("kept").select(F.col(f"`{id_column}`").alias("_kept_id"))
        return docs.join(kept, own.eqNullSafe(F.col("_kept_id")), "left_semi")
    # Ids do not tell rows apart, so rows are numbered; the stored table keeps the numbers.
    rows = stored(
        docs.select(
            F.monotonically_increasing_id().alias("number"),
            own.alias("id"),
            F.col(f"`{text_column}`").alias("text"),
            F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        ),
        "rows",
    )
    found = jaccard_components(rows.select("number", "text"), "number", "text", width, percent)
    members = stored(found.select("number", "component_id"), "members").join(rows.select("number", "id"), "number")
    order = F.struct(F.col("id").isNull(), "id", "number")
    kept = members.groupBy("component_id").agg(F.min(order).alias("first")).select(F.col("first.number").alias("number"))
    return rows.join(kept, "number", "left_semi").select("row.*")
