"""Operator 7: n-gram Jaccard join with a MinHash LSH forest and exact verification."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from eventlens.llm import graph as G
from eventlens.llm import words as W
from eventlens.session import cut_lineage

SHINGLE = 5
THRESHOLD = (4, 5)  # similarity 0.8, as a fraction so that comparisons are exact
TREES = 24
LEVELS = 8  # levels of a tree: 8 bits of a min-hash each, the first in the top byte of a long
RECALL = 0.999
BLOCK_SHINGLES = 300_000
BLOCK_TEXTS = 1024


def prefix_depth(trees: int, recall: float, similarity: float) -> int:
    """Deepest common prefix that still reaches the recall, shortened level by level.

    A pair of the given similarity shares a prefix of d levels in one tree with
    probability similarity**d, so in any of the trees with
    1 - (1 - similarity**d)**trees; more similar pairs are likelier still.
    """
    for d in range(LEVELS, 1, -1):
        if 1 - (1 - similarity ** d) ** trees >= recall:
            return d
    return 1


def shingles_of(words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of five words (a shorter text: of all its words) and row offsets; repeats stay."""
    h = words.hashes()
    n = words.counts
    size = np.minimum(n, SHINGLE)
    per_row = np.where(n > 0, n - size + 1, 0)
    ends = np.concatenate(([0], np.cumsum(per_row)))
    row = np.repeat(np.arange(len(n)), per_row)
    start = words.rows[row] + np.arange(ends[-1]) - ends[row]
    return W.gram_spans(h).hash(start, start + size[row]), ends


_seeds = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, (TREES * LEVELS, 2), dtype=np.uint64) | np.uint64(1)


def _labels(shingles: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One label per row and tree: LEVELS min-hashes, eight bits each."""
    some = np.flatnonzero(np.diff(ends))
    out = np.zeros((len(ends) - 1, TREES), np.uint64)
    if not len(some):
        return out.astype(np.int64)
    at = ends[some]
    for t in range(TREES):
        label = np.zeros(len(some), np.uint64)
        for lv in range(LEVELS):
            a, b = _seeds[t * LEVELS + lv]
            m = W.mix(np.minimum.reduceat(shingles * a + b, at))
            label = (label << np.uint64(8)) | (m & np.uint64(255))
        out[some, t] = label
    return out.astype(np.int64)


def _signature(text: pa.Array) -> pa.Array:
    """Number of shingles (with repeats; 0: no words) and the labels in every tree."""
    data, at = W.string_buffers(text)
    n, labels = [np.zeros(0, np.int64)], [np.zeros((0, TREES), np.int64)]
    for i, j in W.slices(at, 1 << 20):
        sh, ends = shingles_of(W.find_words(data[at[i]:at[j]], at[i:j + 1] - at[i]))
        n.append(np.diff(ends))
        labels.append(_labels(sh, ends))
    values = pa.array(np.concatenate(labels).ravel())
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(text) + 1, dtype=np.int32) * TREES), values)
    return pa.StructArray.from_arrays([pa.array(np.concatenate(n), pa.int32()), lists], ["n", "labels"])


def _shingle_set(text: pa.Array) -> pa.Array:
    """The sorted distinct shingle hashes of each text, eight bytes each."""
    data, at = W.string_buffers(text)
    out = []
    for i, j in W.slices(at):
        sh, ends = shingles_of(W.find_words(data[at[i]:at[j]], at[i:j + 1] - at[i]))
        out += [np.unique(sh[a:b]).tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
    return pa.array(out, pa.binary())


def _trie_edges(batches):
    """Rows sorted by (prefix, label): every text points to the first of its trie node."""
    carry = None
    for batch in batches:
        group, node = batch.column("prefix").to_numpy(), batch.column("node").to_numpy()
        first, carry = G.first_of_run(group, node, carry)
        other = first != node
        yield G._edges(node[other], first[other])


def _pairs(lens: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which texts of ``left`` (rows) and ``right`` reach the threshold, by exact intersections."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), lens)
    _, col, seen = np.unique(flat, return_inverse=True, return_counts=True)
    shared = seen[col] > 1
    col, owner = col[shared], owner[shared]
    _, col = np.unique(col, return_inverse=True)
    by = np.argsort(col, kind="stable")
    col, owner = col[by], owner[by]
    inter = np.zeros((len(left), len(right)), np.float32)
    to_left, to_right = np.full(len(sets), -1), np.full(len(sets), -1)
    to_left[left], to_right[right] = np.arange(len(left)), np.arange(len(right))
    width = max(64, (4 << 20) // len(sets))
    top = int(col[-1]) + 1 if len(col) else 0
    for c in range(0, top, width):
        lo, hi = np.searchsorted(col, (c, c + width))
        o, k = owner[lo:hi], col[lo:hi] - c
        a = np.zeros((len(left), min(width, top - c)), np.float32)
        b = np.zeros((len(right), a.shape[1]), np.float32)
        x = to_left[o] >= 0
        a[to_left[o[x]], k[x]] = 1
        x = to_right[o] >= 0
        b[to_right[o[x]], k[x]] = 1
        inter += a @ b.T
    union = lens[left][:, None] + lens[right][None, :] - inter
    return THRESHOLD[1] * inter >= THRESHOLD[0] * union


def _verify(batches):
    """Link counts and a local root for each text of a pair of blocks."""
    for table in G.grouped(batches, ("comp", "bi", "bj")):
        node = table["node"].to_numpy()
        _, keep = np.unique(node, return_index=True)
        node = node[keep]
        if len(node) < 2:
            continue
        side, copies = table["block"].to_numpy()[keep], table["copies"].to_numpy()[keep].astype(np.int64)
        blobs = table["shingles"].take(pa.array(keep))
        sets = [np.frombuffer(b.as_buffer(), np.uint64) for b in blobs]
        lens = np.array([len(s) for s in sets])
        bi, bj = table["bi"][0].as_py(), table["bj"][0].as_py()
        left, right = np.flatnonzero(side == bi), np.flatnonzero(side == bj)
        if not len(left) or not len(right):
            continue
        near = _pairs(lens, sets, left, right)
        linked = np.zeros((len(node), len(node)), bool)
        linked[np.ix_(left, right)] = near
        linked |= linked.T
        np.fill_diagonal(linked, False)
        some = np.flatnonzero(linked.any(1))
        if not len(some):
            continue
        linked = linked[np.ix_(some, some)]
        links = linked @ copies[some]
        root = np.arange(len(some))
        while True:  # least index reached through links
            new = np.minimum(root, np.where(linked, root[None, :], len(some)).min(1))
            new = new[new]
            if (new == root).all():
                break
            root = new
        yield pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(node[some][root]), pa.array(links),
                                          pa.array(np.full(len(some), table["blocks"][0].as_py()), pa.int32())],
                                         ["a", "b", "links", "blocks"])


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 recall: float = RECALL) -> DataFrame:
    """Near-duplicate classes: ``id, key, class_id, n_links, class_size`` for every document.

    Texts are sets of five-word shingles (words are runs of anything but space
    and \\t \\n \\v \\f \\r, unchanged; a text under five words is one shingle); two
    texts are linked if the Jaccard similarity of their sets is 0.8 or more.
    ``n_links`` counts the linked documents, copies included; ``class_id`` is the
    smallest id of the documents connected through links; ``key`` is the text's
    MD5, so equal texts share one.

    Method.  Equal texts are joined to one representative by key.  An LSH forest
    holds a label of eight min-hash levels for each tree; the tries are the
    labels sorted within a tree, and the matched prefix is shortened from the
    full depth until the expected recall at the threshold reaches ``recall``.
    Texts under a common trie node are candidates; their connected components
    are small, share their shingle sets once, and are verified exactly by set
    intersection.  A component beyond a block's size is split by hash into
    blocks, and every pair of blocks is one bounded unit of work, so no group
    has to fit in a task and no pair is skipped.  Links are counted in place:
    pairs are never emitted, only a row for each text and pair of blocks.

    Defined results: null, empty and wordless texts have no shingles; they have
    no links, and each is its own class (class_id is their id).  Rows that
    repeat an id and text count as copies of each other.  Null ids never become
    a class_id unless all ids of the class are null.  An empty table gives an
    empty table.
    """
    depth = prefix_depth(TREES, recall, THRESHOLD[0] / THRESHOLD[1])
    text = F.col(f"`{text_col}`").cast("string")
    keyed = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.unhex(F.md5(F.coalesce(text, F.lit("")))).alias("key"), text.alias("text"))
    base = cut_lineage(keyed.select("id", "key", arrow_udf(_signature, "struct<n:int,labels:array<long>>")("text").alias("s")).select("id", "key", "s.n", "s.labels"))
    reps = base.where("n > 0").groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("copies"),
                                                  F.first("n").alias("n"), F.first("labels").alias("labels"))
    reps = cut_lineage(reps.withColumn("node", F.monotonically_increasing_id()))
    nodes = reps.select("node", F.posexplode("labels").alias("tree", "label")) \
                .select("node", "label", F.xxhash64("tree", F.shiftright("label", 8 * (LEVELS - depth))).alias("prefix"))
    edges = nodes.repartition("prefix").sortWithinPartitions("prefix", "label", "node").mapInArrow(_trie_edges, G.EDGE)
    near = G.components(edges).withColumnRenamed("component", "comp")
    sizes = near.join(reps.select("node", "n"), "node").groupBy("comp").agg(F.sum("n").alias("total"), F.count("*").alias("texts"))
    blocks = F.greatest(F.ceil(F.col("total") / BLOCK_SHINGLES), F.ceil(F.col("texts") / BLOCK_TEXTS)).cast("int")
    member = near.join(sizes.select("comp", blocks.alias("blocks")), "comp").join(reps.select("node", "key", "id", "copies"), "node") \
                 .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # One text for each representative: the row that holds its smallest id.
    texts = keyed.join(member.withColumnRenamed("id", "rep"), "key").where(F.col("id").eqNullSafe(F.col("rep")))
    sets = texts.select("node", "comp", "copies", "block", "blocks", arrow_udf(_shingle_set, "binary")("text").alias("shingles"))
    dealt = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "comp", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"), "node", "copies", "block", "blocks", "shingles")
    found = dealt.repartition("comp", "bi", "bj").sortWithinPartitions("comp", "bi", "bj") \
                 .mapInArrow(_verify, "a long, b long, links long, blocks int")
    found = cut_lineage(found)
    links = found.groupBy("a").agg(F.sum("links").alias("links"))
    roots = found.where("blocks = 1").select(F.col("a").alias("node"), F.col("b").alias("root")) \
                 .union(G.components(found.where("blocks > 1").select("a", "b")))
    node = reps.join(links.withColumnRenamed("a", "node"), "node", "left").join(roots, "node", "left") \
               .select("key", "node", "id", "copies", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    classes = node.groupBy("root").agg(F.min("id").alias("class_id"), F.sum("copies").alias("class_size"))
    verdict = node.join(classes, "root").select("key", "class_id", "class_size", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    some, none = base.where("n > 0").select("id", "key"), base.where("n = 0")
    return some.join(verdict, "key").select("id", "key", "class_id", "n_links", "class_size").unionByName(
        none.select("id", "key", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("class_size")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with the smallest id of their class, with their columns; of repeated rows one stays.

    Texts without words have no class and all stay.
    """
    lead = jaccard_join(docs, id_col, text_col).where("class_size > 1 and not (id <=> class_id)").select("id", "key").distinct()
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(f"`{id_col}`").cast("long").alias("id"), F.unhex(F.md5(F.coalesce(text, F.lit("")))).alias("key"),
                       text.rlike("[^\\x20\\x09-\\x0D]").alias("worded"))
    kept = rows.join(lead, rows["id"].eqNullSafe(lead["id"]) & (rows["key"] == lead["key"]), "left_anti")
    worded = kept.where("worded").dropDuplicates(["key"])
    return worded.select("row.*").unionByName(kept.where("worded is null or not worded").select("row.*"))
