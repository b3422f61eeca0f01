"""SimHash near-duplicates by a self-join of the fingerprints' binary trie.

The join walks pairs of trie nodes downwards together, from the pair of the root
with itself. The bits in which a pair's prefixes differ are added up, and a pair
is dropped as soon as they exceed the budget. Near the top Spark walks, some bits
at a time, over counts of fingerprints by prefix only, until few fingerprints are
below each pair; then the fingerprints are dealt to these pairs, and tasks walk
them down bit by bit to the last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotline.llm.common import shared
from slotline.llm.components import components, star_forest

BITS = 64
#: Fingerprints below a pair of nodes that a task gets.
NODE_ROWS = 4096
#: Bits that Spark takes a pair of nodes down at a time.
STEP = 2
#: Fingerprints that a task walks at a time.
CHUNK = 8192


def fingerprint(data: bytes, shingle: int = 3) -> int:
    """The SimHash of a text's word shingles; 0 for a text without words.

    A-Z are lower-cased; words are runs of anything but ASCII white space;
    repeated shingles count each time; a text of fewer words than a shingle has
    is one shingle. Bits are those of XXH64 with seed 42, and 1 where over half
    the shingles have them.
    """
    words = data.lower().split()
    if not words:
        return 0
    text = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(lengths[:-1] + 1)])
    ends = starts + lengths
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_digest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), 50_000):  # 50,000 shingles' bits are 3 MB
        part = zip(starts[at : at + 50_000].tolist(), ends[at : at + 50_000].tolist(), strict=True)
        raw = np.frombuffer(b"".join([digest(text[a:b], 42) for a, b in part]), np.uint8)
        ones += np.unpackbits(raw.reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(starts)).tobytes(), "big")


def fingerprints(documents: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, text_hash (as xxhash64(text)) and fp of every document, from its whole text."""
    slim = documents.select("doc_id", "text")
    kind = slim.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, hashes = [], []
            for text in batch.column(1):
                data = text.as_buffer() if text.is_valid else None
                data = b"" if data is None else data.to_pybytes()
                prints.append(fingerprint(data, shingle))
                hashes.append(xxhash.xxh64_intdigest(data, 42) if text.is_valid else 42)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.array(hashes, np.uint64).view(np.int64)),
                    pa.array(np.array(prints, np.uint64).view(np.int64)),
                ],
                ["doc_id", "text_hash", "fp"],
            )

    return slim.mapInArrow(run, f"doc_id {kind}, text_hash long, fp long")


def walk(keys: np.ndarray, pairs: np.ndarray, depth: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Walks pairs of trie nodes down from ``depth`` bits; returns the linked pairs of rows.

    ``keys`` are fingerprints, ordered within every node; ``pairs`` has
    the columns a0, a1, b0, b1 (rows of either node; equal nodes for a node with
    itself) and the bits in which they differ so far. All pairs go down a bit
    together, to the leaves: keys don't repeat, so a pair left there is a link. A
    key has at most 1 + 64 + 2016 others within two bits, however many there are.
    """
    for bit in range(BITS - 1 - depth, -1, -1):
        if not len(pairs):
            break
        ones = np.concatenate([[0], np.cumsum((keys >> np.uint64(bit)) & np.uint64(1), dtype=np.int32)]).astype(np.int32)
        a0, a1, b0, b1, e = pairs.T
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        own = a0 == b0
        children = np.concatenate(
            [
                np.stack([a0, am, b0, bm, e], 1),
                np.stack([am, a1, bm, b1, e], 1),
                np.stack([a0, am, bm, b1, e + 1], 1),
                np.stack([am, a1, b0, bm, e + 1], 1)[~own],
            ]
        )
        a0, a1, b0, b1, e = children.T
        pairs = children[(a1 > a0) & (b1 > b0) & (e <= most) & ~((a0 == b0) & (a1 - a0 == 1))]
    return pairs[:, 0], pairs[:, 2]


def _walk_nodes(most: int):
    """A task's work: rows (depth, pa, pb, side, key), ordered so, to links of fingerprints."""
    names = ("depth", "pa", "pb")

    def links(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
        u, v = [], []
        for depth in np.unique(rows["depth"]):
            at = rows["depth"] == depth
            own = {k: x[at] for k, x in rows.items()}
            keys = own["key"].view(np.uint64)
            new = np.concatenate([[True], np.any([own[k][1:] != own[k][:-1] for k in names], axis=0)])
            start = np.flatnonzero(new)
            end = np.append(start[1:], len(keys))
            sides = np.concatenate([[0], np.cumsum(own["side"])])
            mid = end - (sides[end] - sides[start])
            same = own["pa"][start] == own["pb"][start]
            pairs = np.stack(
                [start, np.where(same, end, mid), np.where(same, start, mid), end,
                 np.bitwise_count(own["pa"][start] ^ own["pb"][start])], 1,
            ).astype(np.int32)
            i, j = walk(keys, pairs, int(depth), most)
            u.append(own["key"][i])
            v.append(own["key"][j])
        node, root = star_forest(np.concatenate(u), np.concatenate(v))
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        for batch in batches:
            held.append({k: batch.column(k).to_numpy(zero_copy_only=False) for k in batch.schema.names})
            if sum(len(x["key"]) for x in held) < CHUNK:
                continue
            rows = {k: np.concatenate([x[k] for x in held]) for k in held[0]}
            cuts = np.flatnonzero(np.any([rows[k][1:] != rows[k][:-1] for k in names], axis=0)) + 1
            at = 0
            for cut in cuts.tolist():  # whole pairs of nodes; the last may go on in the next batch
                if cut - at >= CHUNK or cut == cuts[-1]:
                    yield links({k: x[at:cut] for k, x in rows.items()})
                    at = cut
            held = [{k: x[at:] for k, x in rows.items()}]
        if held and sum(len(x["key"]) for x in held):
            yield links({k: np.concatenate([x[k] for x in held]) for k in held[0]})

    return run


def _prefix(depth: int) -> Column:
    """A fingerprint's first ``depth`` bits."""
    return F.shiftrightunsigned("fp", BITS - depth) if depth else F.lit(0).cast("long")


def node_pairs(fps: DataFrame, *, most: int, node_rows: int) -> DataFrame:
    """Pairs (depth, pa, pb) of trie nodes, pa <= pb, below which all pairs of fingerprints within ``most`` bits lie once.

    The walk from (root, root): the prefixes' counts at each level are joined to
    the pairs that are still overfull, for either side's children that keep to
    the budget. A pair is ready with ``node_rows`` fingerprints or fewer on both
    sides together, or where only bits are left that a task walks.
    """
    spark = fps.sparkSession
    masks = F.array(*[F.lit(m).cast("long") for m in range(1 << STEP) if m.bit_count() <= most])
    low = F.lit((1 << STEP) - 1).cast("long")
    large = spark.createDataFrame([(0, 0, 0)], "pa long, pb long, e int")
    found = None
    for depth in range(STEP, BITS, STEP):
        counts = fps.groupBy(_prefix(depth).alias("p")).agg(F.count(F.lit(1)).alias("n"))
        nodes = counts.withColumn("_up", F.shiftrightunsigned("p", STEP))
        a = large.join(nodes.select(F.col("_up").alias("pa"), F.col("p").alias("_a"), F.col("n").alias("_na")), "pa")
        # below a node with itself, only the pairs in order; else all
        b = a.withColumn("_m", F.explode(masks)).withColumn(
            "_b", F.shiftleft("pb", STEP).bitwiseOR(F.col("_a").bitwiseAND(low).bitwiseXOR(F.col("_m")))
        ).where((F.col("e") + F.bit_count("_m") <= most) & ((F.col("pa") < F.col("pb")) | (F.col("_a") <= F.col("_b"))))
        down = b.join(nodes.select(F.col("p").alias("_b"), F.col("n").alias("_nb")), "_b")
        rows = F.when(F.col("_a") == F.col("_b"), F.col("_na")).otherwise(F.col("_na") + F.col("_nb"))
        down = down.where((F.col("_a") < F.col("_b")) | (F.col("_na") > 1)).select(
            F.col("_a").alias("pa"), F.col("_b").alias("pb"), (F.col("e") + F.bit_count("_m")).cast("int").alias("e"),
            (rows <= node_rows).alias("ready"),
        )
        down = shared(down)
        last = depth + STEP >= BITS
        own = down if last else down.where("ready")
        own = own.select(F.lit(depth).alias("depth"), "pa", "pb")
        found = own if found is None else found.unionByName(own)
        large = down.where("NOT ready").select("pa", "pb", "e")
        if last or large.isEmpty():
            return found


def linked_fingerprints(fps: DataFrame, *, most: int = 2, node_rows: int = NODE_ROWS) -> DataFrame:
    """Links (u, v) that join the same fingerprints as all pairs differing in ``most`` bits or fewer.

    ``fps`` has a column fp without repeats. Each task returns a spanning forest
    of the pairs it finds, so a dense group costs a link for each of its members.
    """
    pairs = shared(node_pairs(fps, most=most, node_rows=node_rows))
    depths = [r["depth"] for r in pairs.select("depth").distinct().collect()]  # at most BITS / STEP
    if not depths:
        return fps.sparkSession.createDataFrame([], "u long, v long")
    own = F.array(*[F.struct(F.lit(d).alias("depth"), _prefix(d).alias("p")) for d in sorted(depths)])
    rows = fps.select("fp", F.explode(own).alias("at")).select(F.col("at.depth").alias("depth"), F.col("at.p").alias("p"), F.col("fp").alias("key"))
    sides = pairs.select(
        "depth", "pa", "pb",
        F.explode(F.when(F.col("pa") == F.col("pb"), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))).alias("side"),
    ).withColumn("p", F.when(F.col("side") == 0, F.col("pa")).otherwise(F.col("pb")))
    node = ["depth", "pa", "pb"]
    dealt = rows.join(sides, ["depth", "p"]).select(*node, "side", "key").repartition(*node)
    return dealt.sortWithinPartitions(*node, "side", "key").mapInArrow(_walk_nodes(most), "u long, v long")


def near_duplicates(documents: DataFrame, *, most: int = 2, shingle: int = 3, node_rows: int = NODE_ROWS) -> DataFrame:
    """One row per document: doc_id, text_hash, fingerprint, component_id, keep.

    Fingerprints link at ``most`` differing bits or fewer; component_id is the
    smallest doc_id reachable, null only where no member has an id. ``keep``
    marks one text of each component: that of the smallest doc_id (nulls last),
    then of the smallest hash; exactly repeated rows are all marked. Texts
    without words (null, empty) have fingerprint zero and are linked like any
    other. An empty table gives an empty result; other columns are ignored.
    """
    prints = shared(fingerprints(documents, shingle))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    groups = shared(prints.groupBy("fp").agg(F.min(order).alias("first")))
    roots = components(linked_fingerprints(groups.select("fp"), most=most, node_rows=node_rows))
    rooted = groups.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first"
    )
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first"))
    classes = rooted.select("fp", "root").join(firsts, "root").select("fp", "first")
    return prints.join(classes, "fp").select(
        "doc_id", "text_hash", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"), (order == F.col("first")).alias("keep"),
    )
