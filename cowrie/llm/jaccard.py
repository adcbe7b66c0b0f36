"""N-gram Jaccard self-join of documents by signature trees.

1.  Every document becomes the set of its hashed shingles; equal sets form a class.
2.  Candidates.  Two linked sets of a size band differ in at most ``d`` tokens, also
    without the tokens a sample shows to be common.  Tokens are dealt by hash to more
    than ``d`` cells; a cell's tokens with its band and number are a key, and linked
    sets share at least ``SHARED`` keys.  Each key brings a sketch of its set: its size
    and how many of its tokens fall into each of some buckets.  Sets of a rare key are
    paired where their sketches allow a link; sets of a frequent key are chained.  Of all
    pairs and chains a task sends a forest, so no more edges than sets.  They connect
    clusters, which no link leaves.  (A set whose equal cells may all be empty is chained
    and also has keys for its empty cells.)  Clusters are cut where the signatures of
    their sets, counts of tokens in more buckets, allow no link.
3.  Links.  A small cluster becomes a signature tree that is joined with itself.  The
    distinct sets of a large one are dealt to blocks of bounded size, by size and hash;
    each block makes a tree with the first blocks of its size and the next.  What is
    then outside the largest component of the cluster meets all blocks of its own and
    the neighbouring sizes, again by trees.  Connected pairs need no comparison.
4.  The connected components of the links are the groups.

No step holds a group as a whole: keys are combined where they are made, chains and
components are edge lists, and hot clusters are blocks of ``BLOCK`` sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from cowrie.llm.components import components
from cowrie.llm.ngrams import slices
from cowrie.llm.shingles import forget_words, mixed, set_id, shingles
from cowrie.llm.signature_tree import join
from cowrie.llm.slices import bounded, release
from cowrie.llm.tokens import forget
from cowrie.session import shared_folder

#: Tokens of a cell in the smallest set of a band, about, and keys that linked sets share.
FILL, SHARED = 3.2, 1
#: Sets of a key that are paired; those of more frequent keys are chained.
RARE = 16
#: Pairs compared by their sketches at a time, pairs held before they become a forest.
PAIRS_TOGETHER, PAIRS_HELD = 20_000, 100_000
#: Buckets of a sketch, four bits each; eight bits more are the size, in steps of this ratio.
BUCKETS, STEP = 14, 1.04
#: Documents that show which tokens are common, documents of them that must have one, tokens kept.
SAMPLE, COMMON, MOST_COMMON = 5_000, 4, 500_000
#: Keys of a task that chains them, about, and keys a task combines at most before it sends them.
KEYS_TOGETHER, KEYS_SENT = 250_000, 100_000
#: Sets of a block and tokens of their sets, about; a tree holds at most two blocks.
BLOCK, BLOCK_TOKENS = 1_000, 2_000_000
#: Signatures of one side of a tile that cuts a large cluster, about; bits of the number of their buckets.
SIGNATURES, LEAST_BITS, MOST_BITS = 4_000, 4, 11
#: Bytes of signatures compared at a time.
BYTES_TOGETHER = 4_000_000
#: Bytes of a key, of a node and of a sketch between two tasks.
KEY_BYTES, NODE_BYTES, SEEN_BYTES = 5, 6, 8
#: Bits of the filter of documents that have to be read again: 8 MB.
FILTER_BITS = 26


def _limits(percent: int) -> np.ndarray:
    """Limits of the size bands: so narrow that the smallest partner fills most cells, but at least 100 / percent."""
    t = percent / 100
    ratio = max(1 / t, t * (1 + t) / (2 * (1 - t) * FILL)) if t < 1 else 2.0
    return np.unique(np.ceil(ratio ** np.arange(1 + int(48 / np.log2(ratio)))).astype(np.int64))


def bands(size: int, percent: int) -> list[tuple[int, int, int]]:
    """``band, cells, d`` of the bands a set of ``size`` tokens has keys for.

    A pair belongs to the band of its larger set, so a set also has keys for further
    bands that hold sets it can be linked with.  Bands without links of different sets
    are left out.
    """
    if percent not in _LIMITS:
        _LIMITS[percent] = _limits(percent)
    limits = _LIMITS[percent]
    band = int(np.searchsorted(limits, size, "right")) - 1
    found = []
    while limits[band] <= size or 100 * size >= percent * limits[band]:
        d = (100 - percent) * 2 * (int(limits[band + 1]) - 1) // (100 + percent)
        if d:
            found.append((band, d + SHARED + 2 + d // 8, d))
        band += 1
    return found


_LIMITS: dict[int, np.ndarray] = {}


def keys(tokens: np.ndarray, percent: int, common: np.ndarray = np.empty(0, np.uint64)) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a set of ascending hashed tokens, and which of them have to be chained.

    Linked different sets share at least ``SHARED`` keys, or one that one of them chains.
    """
    found, chained = [], []
    rare = tokens
    if len(common):
        rare = tokens[common[np.minimum(np.searchsorted(common, tokens), len(common) - 1)] != tokens]
    for band, cells, d in bands(len(tokens), percent):
        cell = ((rare >> np.uint64(32)) * np.uint64(cells)) >> np.uint64(32)  # ascending, like the tokens
        begin = np.flatnonzero(np.diff(cell, prepend=np.uint64(cells)) != 0)
        held, number = (np.add.reduceat(mixed(rare), begin), cell[begin]) if len(begin) else (rare, rare)
        sure = len(begin) - d  # at least so many equal cells aren't empty
        if sure <= 0:
            empty = np.setdiff1d(np.arange(cells, dtype=np.uint64), number)
            number, held = np.append(number, empty), np.append(held, np.zeros(len(empty), np.uint64))
        found.append(mixed(mixed(number + np.uint64(band << 32)) ^ held))
        chained.append(np.full(len(number), sure < SHARED))
    if not found:
        return np.empty(0, np.uint64), np.empty(0, bool)
    return np.concatenate(found), np.concatenate(chained)


def _common(docs: DataFrame, n: int) -> np.ndarray:
    """Tokens of ``COMMON`` or more documents of a sample of about ``SAMPLE``, ascending.

    Any list is right, as links survive the loss of tokens; this one keeps frequent
    passages and phrases from making keys.
    """
    rows = docs.count()
    drawn = docs.where(F.pmod(F.xxhash64("doc_id", F.lit("common")), F.lit(1 << 30)) < SAMPLE / max(rows, 1) * (1 << 30))
    schema = pa.schema([("token", pa.int64())])

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in slices(batches):
            found = [shingles(t, n).view(np.int64) for t in columns["text"]]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], schema=schema)
        forget_words()

    counts = drawn.select("text").mapInArrow(tokens, "token long").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    frequent = counts.where(F.col("n") >= COMMON).orderBy(F.desc("n"), "token").limit(MOST_COMMON).select("token").toArrow()
    return np.sort(frequent["token"].to_numpy().view(np.uint64))


_MIXED_ARROW = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("data", pa.binary())])
_MIXED = "part int, kind int, data binary"
_KEYS, _EDGES, _DOCS = 0, 1, 2
_DOC = np.dtype([("has_id", "<i8"), ("doc_id", "<i8"), ("n", "<i8"), ("set_id", "V16")])
_NODE_SHIFT = 64 - 8 * NODE_BYTES
_ONE = np.uint64(1 << _NODE_SHIFT)  # the last bit of a node says that its key has to be chained
#: A node is the beginning of a set's id.  Sets that share one are of one cluster, which costs comparisons.
_NODE = (1 << 64) - (2 << _NODE_SHIFT)


_SIZES = np.array([*np.ceil(STEP ** np.arange(256)), 2.0**50]).astype(np.int64)  # the last step has no end


def sketch(tokens: np.ndarray) -> np.uint64:
    """A set's size, rounded, and how many tokens each bucket has, modulo 16."""
    step = np.searchsorted(_SIZES[1:256], len(tokens), "right")
    counts = np.bincount(((tokens >> np.uint64(16)) % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS) % 16
    return np.uint64(int(step) << 4 * BUCKETS) | np.bitwise_or.reduce(counts.astype(np.uint64) << _NIBBLES)


_NIBBLES = np.arange(0, 4 * BUCKETS, 4, dtype=np.uint64)


def linkable(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets with these sketches may be linked: never False for linked sets.

    A token that only one of two sets has changes the count of one bucket by one, so the
    counts differ by no more than the sets may.
    """
    top = np.uint64(4 * BUCKETS)
    one, other = (a >> top).astype(np.int64), (b >> top).astype(np.int64)
    low, high = np.minimum(one, other), np.maximum(one, other)
    sizes = 100 * _SIZES[low + 1] >= percent * _SIZES[high]
    apart = np.zeros(len(a), np.int64)
    for shift in _NIBBLES:
        x = ((a >> shift) - (b >> shift)).astype(np.int64) & 15
        apart += np.minimum(x, 16 - x)
    return sizes & (apart * (100 + percent) <= (100 - percent) * (_SIZES[low + 1] + _SIZES[high + 1]))


def _combined(key: np.ndarray, node: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys with their nodes and sketches, once each, and edges that chain the nodes of frequent keys.

    Of a chained key only the first node is left, with the mark that it is one.
    """
    if not len(key):
        return key, node, seen, np.empty((0, 2), np.uint64)
    order = np.lexsort((seen, node, key))
    key, node, seen = key[order], node[order], seen[order]
    fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (node[1:] != node[:-1]) | (seen[1:] != seen[:-1])])
    key, node, seen = key[fresh], node[fresh], seen[fresh]
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(begin, len(key)))
    chained = (size > RARE) | (np.bitwise_or.reduceat(node, begin) & _ONE).astype(bool)
    group = np.repeat(np.arange(len(begin)), size)
    first = np.zeros(len(key), bool)
    first[begin] = True
    edges = np.stack([node[begin][group], node], 1)[chained[group] & ~first]
    stays = first | ~chained[group]
    node = np.where(chained[group], node | _ONE, node)
    return key[stays], node[stays], seen[stays], _forest(edges & ~_ONE)


def _paired(key: np.ndarray, node: np.ndarray, seen: np.ndarray, percent: int) -> np.ndarray:
    """A forest of the nodes that share one of these combined keys and may be linked."""
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, int)
    size = np.diff(np.append(begin, len(key)))
    held, total = [np.empty((0, 2), np.uint64)], 0
    for n in np.unique(size[size > 1]).tolist():  # at most RARE
        groups = begin[size == n]
        for k in range(0, len(groups), PAIRS_TOGETHER):
            at = groups[k : k + PAIRS_TOGETHER]
            for i, j in ((i, j) for j in range(n) for i in range(j)):
                fits = at[linkable(seen[at + i], seen[at + j], percent)]
                held.append(np.stack([node[fits + i], node[fits + j]], 1))
                total += len(fits)
                if total > PAIRS_HELD:
                    held = [_forest(np.concatenate(held))]
                    total = 0
    return _forest(np.concatenate(held) & ~_ONE)


def _forest(edges: np.ndarray) -> np.ndarray:
    """Edges from every node to the least one connected with it, which are fewer than nodes."""
    nodes, ends = np.unique(edges, return_inverse=True)
    a, b = ends.reshape(-1, 2).T
    root = np.arange(len(nodes))
    while len(a):
        x, y = root[a], root[b]
        apart = x != y
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while not np.array_equal(up := root[root], root):
            root = up
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return np.stack([nodes[root[moved]], nodes[moved]], 1)


def _packed(key: np.ndarray, node: np.ndarray, seen: np.ndarray, parts: int) -> np.ndarray:
    """Keys of some of ``parts`` as rows of bytes; the part, which isn't among them, is a key's remainder."""
    columns = ((key // np.uint64(parts), 0, KEY_BYTES), (node >> np.uint64(_NODE_SHIFT), 0, NODE_BYTES), (seen, 0, SEEN_BYTES))
    return np.concatenate([c.astype("<u8").view(np.uint8).reshape(-1, 8)[:, a:b] for c, a, b in columns], 1)


def _unpacked(part: int, data: bytes) -> np.ndarray:
    """Rows of key, node and sketch; a key is its part and as many bits as were sent."""
    sent = np.frombuffer(data, np.uint8).reshape(-1, KEY_BYTES + NODE_BYTES + SEEN_BYTES)
    wide, at = np.zeros((len(sent), 3, 8), np.uint8), 0
    for k, size in enumerate((KEY_BYTES, NODE_BYTES, SEEN_BYTES)):
        wide[:, k, :size] = sent[:, at : at + size]
        at += size
    rows = wide.reshape(-1, 24).view("<u8")
    rows[:, 0] |= np.uint64(part << 8 * KEY_BYTES)
    rows[:, 1] <<= np.uint64(_NODE_SHIFT)
    return rows


def _sets_and_chains(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Written ``doc_id, n_shingles, set_id`` of all rows, and edges ``a, b`` between sets' nodes."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    common = spark.sparkContext.broadcast(_common(docs, n))  # at most MOST_COMMON numbers
    # about a third as many keys as words
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + size // 18 // KEYS_TOGETHER)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        random = np.random.default_rng(0)

        def send(held: list[tuple[np.ndarray, np.ndarray, bytes, np.uint64]], rows: list[tuple]) -> pa.RecordBatch:
            out = [(int(random.integers(parts)), _DOCS, np.array(rows, _DOC).tobytes())]
            if held:
                key, sizes = np.concatenate([h[0] for h in held]), [len(h[0]) for h in held]
                own = np.array([int.from_bytes(h[2][:8], "big") for h in held], np.uint64)
                node = np.repeat(own & np.uint64(_NODE), sizes) | np.concatenate([h[1] for h in held]).astype(np.uint64) * _ONE
                seen = np.repeat(np.array([h[3] for h in held], np.uint64), sizes)
                key, node, seen, edges = _combined(key, node, seen)
                out.append((int(random.integers(parts)), _EDGES, edges.astype("<u8").tobytes()))
                part = (key % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                cuts = np.searchsorted(part[order], np.arange(parts + 1))
                dealt = _packed(key[order], node[order], seen[order], parts)
                out += [(p, _KEYS, dealt[a:b].tobytes()) for p, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _MIXED_ARROW)], schema=_MIXED_ARROW)

        held, rows, total, most = [], [], 0, min(KEYS_TOGETHER, KEYS_SENT)
        for columns in slices(bounded(batches, "text")):
            for doc_id, text in zip(columns["doc_id"], columns["text"]):
                tokens = shingles(text, n)
                own = set_id(tokens)
                rows.append((doc_id is not None, doc_id or 0, len(tokens), own))
                if len(tokens) and doc_id is not None:
                    held.append((*keys(tokens, percent, common.value), own, sketch(tokens)))
                    total += len(held[-1][0])
            if total >= most or len(rows) >= most // 5:
                yield send(held, rows)
                held, rows, total = [], [], 0
        if rows:
            yield send(held, rows)
        held.clear()
        forget_words()
        release()

    schema = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("set_id", pa.binary())])
    columns = "kind int, a long, b long, set_id binary"

    def table(kind: int, a, b, sets=None) -> pa.RecordBatch:
        sets = pa.nulls(len(a), pa.binary()) if sets is None else pa.array(sets, pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(a), kind), pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), sets], schema=schema
        )

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes]] = []
        edges: list[np.ndarray] = []
        for batch in batches:
            for part, kind, data in zip(*(batch.column(c).to_pylist() for c in ("part", "kind", "data"))):
                if kind == _KEYS:
                    held.append((part, data))
                elif kind == _EDGES:
                    edges.append(np.frombuffer(data, "<u8").reshape(-1, 2))
                else:
                    rows = np.frombuffer(data, _DOC)
                    ids = pa.array(rows["doc_id"], pa.int64(), mask=rows["has_id"] == 0)
                    yield table(_DOCS, ids, rows["n"], [s.tobytes() for s in rows["set_id"]])
        by_part: dict[int, list[bytes]] = {}
        for part, data in held:
            by_part.setdefault(part, []).append(data)
        held.clear()
        dealt = np.concatenate([np.empty((0, 3), np.uint64), *(_unpacked(p, b"".join(by_part.pop(p))) for p in list(by_part))])
        *combined, chains = _combined(*dealt.T)
        both = _forest(np.concatenate([*edges, chains, _paired(*combined, percent)])).view("<i8")
        yield table(_EDGES, both[:, 0], both[:, 1])
        del dealt, combined, chains, both
        edges.clear()
        release()

    sent = docs.select("doc_id", "text").mapInArrow(make, _MIXED).repartition(parts, "part")
    folder = shared_folder(spark, "shingles")
    sent.mapInArrow(chain, columns).write.parquet(folder)
    found = spark.read.schema(columns).parquet(folder)
    sets = found.where(F.col("kind") == _DOCS).select(F.col("a").alias("doc_id"), F.col("b").alias("n_shingles"), "set_id")
    return sets, found.where(F.col("kind") == _EDGES).select("a", "b")


class MaybeIn:
    """A Bloom filter of fixed size: never misses one of its ids; full, it lets all pass."""

    def __init__(self, ids: DataFrame, column: str) -> None:
        hashed = F.xxhash64(column)
        spots = F.explode(F.array(*(F.shiftrightunsigned(hashed, 64 - FILTER_BITS * k).bitwiseAND((1 << FILTER_BITS) - 1) for k in (1, 2))))
        words = (
            ids.select(spots.alias("spot"))
            .groupBy(F.shiftright("spot", 6).alias("word"))
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("spot").bitwiseAND(63).cast("int"))).alias("bits"))
        )
        table = words.toArrow()  # at most 2 ** (FILTER_BITS - 6) rows
        bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
        bits[table["word"].to_numpy()] = table["bits"].to_numpy()
        self.bits = ids.sparkSession.sparkContext.broadcast(bits.view(np.uint64))

    def split(self, rows: DataFrame, column: str, inside: bool) -> DataFrame:
        """Rows whose id may be one of the filter's, or those whose id isn't."""
        shared = self.bits

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                h = batch.column("_hash").to_numpy().view(np.uint64)
                found = np.ones(len(h), bool)
                for k in (1, 2):
                    spot = (h >> np.uint64(64 - FILTER_BITS * k)) & np.uint64((1 << FILTER_BITS) - 1)
                    found &= (shared.value[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1) == 1
                kept = batch.filter(pa.array(found if inside else ~found))
                yield kept.select([f.name for f in kept.schema if f.name != "_hash"])

        schema = rows.schema
        return rows.withColumn("_hash", F.xxhash64(column)).mapInArrow(keep, schema)


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``tile, side, set_id, text`` of ``wanted (doc_id, set_id, tiles)``; only texts that may be wanted are shuffled."""
    near = MaybeIn(wanted, "doc_id").split(docs.select("doc_id", "text"), "doc_id", True)
    return near.join(wanted, "doc_id").select(F.explode("tiles").alias("_t"), "set_id", "text").select("_t.*", "set_id", "text")


def _linked(tiles: DataFrame, n: int, percent: int) -> DataFrame:
    """Links ``a, b`` between set ids inside each tile of ``tiles (tile, side, set_id, text)``.

    Side 0 is joined with itself, or with side 1 where a tile has one.  Texts are
    shuffled, not sets, which take more room.  Of rows that repeat an id, those with
    another set than the one wanted drop out.
    """
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def links(rows: list[tuple[int, bytes, np.ndarray]]) -> pa.RecordBatch:
        sets = [tokens for _, _, tokens in rows]
        side = np.array([s for s, _, _ in rows])
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        found = join(sets, left, right if len(right) else None, percent) if len(rows) > 1 and len(left) else []
        ids = [(rows[x][1], rows[y][1]) for x, y in found]
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in ids], pa.binary()) for k in (0, 1)], schema=schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held = None, []
        for columns in slices(batches):
            for t, side, own, text in zip(columns["tile"], columns["side"], columns["set_id"], columns["text"]):
                if t != tile and held:
                    yield links(held)
                    held = []
                tile = t
                tokens = shingles(text, n)
                if set_id(tokens) == own:
                    held.append((side, own, tokens))
        if held:
            yield links(held)
        held = []
        forget_words()
        release()

    dealt = tiles.select("tile", "side", "set_id", "text").repartition("tile").sortWithinPartitions("tile")
    return dealt.mapInArrow(work, "a binary, b binary")


def _written(rows: DataFrame, name: str) -> DataFrame:
    folder = shared_folder(rows.sparkSession, name)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def groups(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """``doc_id, n_shingles, set_id, component_id, root`` of every row of ``docs (doc_id, text)``.

    Two documents are linked when their sets of ``n``-word shingles have a Jaccard
    similarity of ``percent`` or more; a document of fewer words has its whole word
    sequence as its only shingle.  ``component_id`` is the smallest ``doc_id`` reachable
    by links, ``root`` tells components apart even where ids repeat.  Rows without words
    are linked with nothing; neither are rows with a null id, whose ``component_id`` is
    null.  Other columns are ignored, repeated rows stay, empty tables give empty results.
    """
    sets, chains = _sets_and_chains(docs, n, percent)
    clusters = components(chains)
    # the beginning of a set's id, as the number that chains know it by
    node = F.conv(F.hex(F.substring("set_id", 1, 8)), 16, -10).cast("long").bitwiseAND(_NODE - (1 << 64))
    real = sets.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = _written(
        real.groupBy("set_id").agg(F.min("doc_id").alias("doc_id"), F.min("n_shingles").alias("n_shingles"))
        .withColumn("node", node), "classes",
    )
    ends = clusters.select(F.col("root").alias("node"), "root").distinct()
    member = _parted(docs, classes.join(clusters.union(ends), "node").withColumnRenamed("root", "cluster"), n, percent)
    counted = member.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("members"), _blocks("n_shingles").alias("all")
    )
    # linked sets of a large cluster have the same or neighbouring heights
    tall = member.join(counted.where("members > 1"), "cluster").withColumn(
        "height", F.when(F.col("all") > 1, _height(percent)).otherwise(-9)
    )
    dealt = tall.groupBy("cluster", "height").agg(_blocks("n_shingles").alias("blocks"))
    placed = _written(
        tall.join(dealt, ["cluster", "height"])
        .withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
        .select("doc_id", "set_id", "cluster", "height", "block"), "members",
    )
    dealt = _written(dealt, "blocks")

    # the first block of a height goes into the trees of its height and of the one below
    below = dealt.select("cluster", (F.col("height") + 1).alias("height"), F.col("blocks").alias("lower"))
    hubs = placed.where("block = 0").join(dealt, ["cluster", "height"]).join(below, ["cluster", "height"], "left")
    into = hubs.select("doc_id", "set_id", "cluster", F.explode(F.array_union(
        F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.col("height").alias("height"), k.alias("at"))),
        F.coalesce(
            F.transform(F.sequence(F.lit(0), F.col("lower") - 1), lambda k: F.struct((F.col("height") - 1).alias("height"), k.alias("at"))),
            F.array().cast("array<struct<height:int,at:int>>"),
        ),
    )).alias("_t")).select("doc_id", "set_id", "cluster", "_t.height", "_t.at")
    others = placed.where("block > 0").select("doc_id", "set_id", "cluster", "height", F.col("block").alias("at"))
    goes = others.unionByName(into).select("doc_id", "set_id", F.xxhash64("cluster", "height", "at").alias("tile"), F.lit(0).alias("side"))
    tiles = _texts_of(docs, _gathered(goes))
    links = _written(_linked(tiles, n, percent), "links")
    many = placed.where("height <> -9")
    if not many.isEmpty():
        outside = _outside(many, components(links))
        links = links.union(_linked(_texts_of(docs, _gathered(outside)), n, percent))
    roots = components(links)
    of_class = classes.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left").select(
        "set_id", "doc_id", F.coalesce("root", "set_id").alias("root")
    )
    least = of_class.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = of_class.join(least, "root").select("set_id", "root", "component_id")
    linkable = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    out = sets.withColumn("_key", F.when(linkable, F.col("set_id"))).join(
        named.withColumnRenamed("set_id", "_key"), "_key", "left"
    )
    return out.select("doc_id", "n_shingles", "set_id", F.coalesce("component_id", "doc_id").alias("component_id"), "root")


def _height(percent: int) -> Column:
    """The step of a set's size: linked sets have the same or neighbouring ones."""
    return F.floor(F.log(F.col("n_shingles")) / float(np.log(100 / percent) * (1 + 1e-9))).cast("int")


def signature(tokens: np.ndarray) -> np.ndarray:
    """How many tokens each of a power of two of buckets has, modulo 256: a byte for some 8 tokens.

    The sums of two neighbours each are the signature of half as many buckets.
    """
    bits = min(max(int(np.ceil(np.log2(max(len(tokens), 1) / 8))), LEAST_BITS), MOST_BITS)
    return np.bincount((tokens >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits).astype(np.uint8)


def close(one: np.ndarray, other: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of ``n`` and ``m`` tokens with these rows of signatures may be linked, each with each.

    Never False for linked sets: a token that only one of two sets has changes one bucket by one.
    """
    apart = one[:, None, :] - other[None, :, :]
    apart = np.minimum(apart, -apart).sum(2, dtype=np.int64)
    return apart * (100 + percent) <= (100 - percent) * (n[:, None] + m[None, :])


def _connected(side: np.ndarray, node: np.ndarray, n: np.ndarray, signatures: list[bytes], percent: int) -> np.ndarray:
    """A forest of the nodes of side 0, or of both sides where there are two, whose sets may be linked."""
    order = np.argsort(n, kind="stable")
    side, node, n = side[order], node[order], n[order].astype(np.int64)
    signatures = [signatures[k] for k in order]
    width = np.array([len(s) for s in signatures])
    held, total = [np.empty((0, 2), np.uint64)], 0

    def compare(a: np.ndarray, b: np.ndarray, rows: np.ndarray, same: bool) -> None:
        nonlocal held, total
        step = max(1, BYTES_TOGETHER // max(1, len(b) * rows.shape[1]))
        for at in range(0, len(a), step):
            some = a[at : at + step]
            low = np.searchsorted(100 * n[b], percent * n[some[0]], "left")
            high = np.searchsorted(percent * n[b], 100 * n[some[-1]], "right")
            near = b[low:high]
            may = close(rows[some], rows[near], n[some], n[near], percent)
            if same:
                may &= some[:, None] < near[None, :]
            i, j = np.nonzero(may)
            held.append(np.stack([node[some[i]], node[near[j]]], 1))
            total += len(i)
            if total > PAIRS_HELD:
                held = [_forest(np.concatenate(held))]
                total = 0

    for w in np.unique(width).tolist():
        own, wider = np.flatnonzero(width == w), np.flatnonzero((width > w) & (percent * width <= 200 * w))
        rows = np.zeros((len(n), w), np.uint8)
        for k in np.unique(width[np.append(own, wider)]).tolist():
            of = np.flatnonzero(width == k)
            rows[of] = np.frombuffer(b"".join(signatures[x] for x in of), np.uint8).reshape(-1, w, k // w).sum(2, dtype=np.uint8)
        if side.max() == 0:
            compare(own, np.append(own, wider), rows, True)  # ascending: wider ones are larger
        else:
            compare(own[side[own] == 0], np.append(own, wider)[side[np.append(own, wider)] == 1], rows, False)
            compare(own[side[own] == 1], wider[side[wider] == 0], rows, False)
    return _forest(np.concatenate(held))


def _signed(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """``doc_id, set_id, signature`` of ``wanted (doc_id)``, once each; texts aren't shuffled."""
    near = MaybeIn(wanted, "doc_id").split(docs.select("doc_id", "text"), "doc_id", True)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            sets = [shingles(t.as_py(), n) for t in batch.column("text")]
            own = [pa.array([f(s) for s in sets], pa.binary()) for f in (set_id, lambda s: signature(s).tobytes())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *own], ["doc_id", "set_id", "signature"])
        forget_words()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return near.mapInArrow(sign, f"doc_id {kind}, set_id binary, signature binary").dropDuplicates(["doc_id", "set_id"])


def _height(percent: int) -> Column:
    """The step of a set's size: linked sets have the same or neighbouring ones."""
    return F.floor(F.log(F.col("n_shingles")) / float(np.log(100 / percent) * (1 + 1e-9))).cast("int")


def _parted(docs: DataFrame, member: DataFrame, n: int, percent: int) -> DataFrame:
    """``member (doc_id, n_shingles, set_id, node, cluster)``, clusters cut where no link can be.

    The signatures of a cluster's sets are compared, of a large one's those of the same and
    of neighbouring heights in bounded tiles.  Sets that may be linked stay together and
    sets without a partner drop out.  Only the texts of what is left are shuffled, in as many
    copies as a cluster has blocks: in clusters that chance or a passage has chained these
    would grow with the square of the corpus.
    """
    member = _written(member, "clusters")
    counted = member.groupBy("cluster").agg(F.count(F.lit(1)).alias("members"), _blocks("n_shingles").alias("all"))
    crowd = _written(
        member.join(counted.where("members > 1"), "cluster")
        .withColumn("height", F.when(F.col("all") > 1, _height(percent)).otherwise(-9))
        .drop("members", "all"), "crowd",
    )
    stacks = crowd.groupBy("cluster", "height").agg(F.ceil(F.count(F.lit(1)) / SIGNATURES).cast("int").alias("stacks"))
    above = stacks.select("cluster", (F.col("height") - 1).alias("height"), F.col("stacks").alias("upper"))
    below = stacks.select("cluster", (F.col("height") + 1).alias("height"), F.col("stacks").alias("lower"))
    dealt = (
        stacks.join(above, ["cluster", "height"], "left").join(below, ["cluster", "height"], "left")
        .join(crowd, ["cluster", "height"]).join(_signed(docs, crowd.select("doc_id"), n), ["doc_id", "set_id"])
        .withColumn("at", F.pmod(F.xxhash64("set_id", F.lit(2)), F.col("stacks")).cast("int"))
    )

    def numbers(count: str) -> Column:
        return F.when(F.col(count) > 0, F.sequence(F.lit(0), F.col(count) - 1)).otherwise(F.array().cast("array<int>"))

    def tile(low: Column, high: Column, left: Column, right: Column, side: Column) -> Column:
        return F.struct(F.xxhash64(F.col("cluster"), low, high, left, right).alias("tile"), side.alias("side"))

    at, own, zero, one = F.col("at"), F.col("height"), F.lit(0), F.lit(1)
    tiles = dealt.select(
        "node", "n_shingles", "signature", F.explode(F.concat(
            F.transform(numbers("stacks"), lambda k: tile(own, own, F.least(k, at), F.greatest(k, at), F.when(k < at, one).otherwise(zero))),
            F.transform(numbers("upper"), lambda k: tile(own, own + 1, at, k, zero)),
            F.transform(numbers("lower"), lambda k: tile(own - 1, own, k, at, one)),
        )).alias("_t"),
    ).select("_t.*", "node", "n_shingles", "signature")
    finer = components(_linkable(tiles, percent))
    ends = finer.select(F.col("root").alias("node"), "root").distinct()
    parts = crowd.join(finer.union(ends), "node").withColumn("cluster", F.xxhash64("cluster", "root"))
    return _written(parts.drop("root", "height"), "parted")


def _linkable(tiles: DataFrame, percent: int) -> DataFrame:
    """Edges ``a, b`` that connect the nodes of each tile of ``tiles (tile, side, node, n_shingles, signature)`` that may be linked."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def edges(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        own = pa.Table.from_batches(rows)
        side, node, n = (own.column(c).to_numpy() for c in ("side", "node", "n_shingles"))
        found = _connected(side, node.view(np.uint64), n, own.column("signature").to_pylist(), percent).view("<i8")
        return pa.RecordBatch.from_arrays([pa.array(found[:, k]) for k in (0, 1)], schema=schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            tile = batch.column("tile").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(tile)) + 1).tolist(), len(tile)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    if held and tile[a] != last:
                        yield edges(held)
                        held = []
                    last = tile[a]
                    held.append(batch.slice(a, b - a))
        if held:
            yield edges(held)
        held = []
        release()

    dealt = tiles.select("tile", "side", "node", "n_shingles", "signature").repartition("tile").sortWithinPartitions("tile")
    return dealt.mapInArrow(work, "a long, b long")


def _blocks(size: str) -> Column:
    return F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum(size) / BLOCK_TOKENS)).cast("int")


def _gathered(goes: DataFrame) -> DataFrame:
    """One row for each document, with the list of its tiles: its text is looked up once."""
    tile = F.struct("tile", "side")
    return _written(goes.groupBy("doc_id", "set_id").agg(F.collect_set(tile).alias("tiles")), "tiles")


def _outside(many: DataFrame, roots: DataFrame) -> DataFrame:
    """Tiles of the sets outside the largest component of their cluster with the blocks near their size."""
    rooted = many.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn(
        "root", F.coalesce("root", "set_id")
    )
    sizes = rooted.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy("cluster").agg(F.max_by("root", F.struct("size", "root")).alias("largest"))
    outside = rooted.join(largest, "cluster").where("root <> largest")
    stacks = outside.groupBy("cluster", "height").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("stacks"))
    blocks = many.groupBy("cluster", "height").agg((F.max("block") + 1).alias("blocks"))
    near = F.explode(F.array(*(F.col("height") + k for k in (-1, 0, 1))))

    def tile(stack: Column, at: Column, low: Column, high: Column) -> Column:
        return F.xxhash64("cluster", low, stack, high, at)

    left = (
        outside.join(stacks, ["cluster", "height"])
        .withColumn("stack", F.pmod(F.xxhash64("set_id", F.lit(1)), F.col("stacks")).cast("int"))
        .select("doc_id", "set_id", "cluster", F.col("height").alias("own"), "stack", near.alias("height"))
        .join(blocks, ["cluster", "height"])
        .withColumn("at", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("doc_id", "set_id", tile(F.col("stack"), F.col("at"), F.col("own"), F.col("height")).alias("tile"), F.lit(0).alias("side"))
    )
    right = (
        many.select("doc_id", "set_id", "cluster", "block", F.col("height").alias("own"), near.alias("height"))
        .join(stacks, ["cluster", "height"])
        .withColumn("stack", F.explode(F.sequence(F.lit(0), F.col("stacks") - 1)))
        .select("doc_id", "set_id", tile(F.col("stack"), F.col("block"), F.col("height"), F.col("own")).alias("tile"), F.lit(1).alias("side"))
    )
    return left.unionByName(right)


def deduplicated(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs``, with all their columns: of each group of linked rows one with the smallest ``doc_id``.

    Rows without words and rows with a null id all stay.  Other columns may have any name.
    """
    own = docs.columns
    docs = docs.toDF(*(c if c in ("doc_id", "text") else f"c{k}" for k, c in enumerate(own)))
    found = _written(groups(docs, n, percent), "groups")
    alone = F.col("root").isNull()
    repeated = found.where(~alone).groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("doc_id")
    # what may not simply stay: rows with a smaller one in their group, and repeated ids
    doubtful = found.where(~alone & (F.col("doc_id") != F.col("component_id"))).select("doc_id").union(repeated).distinct()
    maybe = MaybeIn(_written(doubtful, "doubtful"), "doc_id")
    schema = StructType([*docs.schema.fields, StructField("_set_id", BinaryType())])

    def tagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            ids = [set_id(shingles(t.as_py(), n)) for t in batch.column("text")]
            yield batch.append_column("_set_id", pa.array(ids, pa.binary()))
        forget_words()

    rows = maybe.split(docs, "doc_id", True).mapInArrow(tagged, schema)
    verdict = found.select(
        F.col("doc_id").alias("_doc_id"), F.col("set_id").alias("_set"), F.col("root").alias("_root"),
        (alone | (F.col("doc_id") == F.col("component_id"))).alias("_stays"),
    ).distinct()
    kept = rows.join(verdict, rows["doc_id"].eqNullSafe(verdict["_doc_id"]) & (rows["_set_id"] == verdict["_set"])).where("_stays")
    # what is left of a group has the same id; rows of no group all stay
    single = F.coalesce("_root", F.xxhash64("doc_id", "text").cast("string").cast("binary"))
    order = Window.partitionBy(single).orderBy("_set_id", "text")
    ranked = kept.withColumn("_rank", F.when(F.col("_root").isNull(), 1).otherwise(F.row_number().over(order)))
    return ranked.where("_rank = 1").select(docs.columns).unionByName(maybe.split(docs, "doc_id", False)).toDF(*own)
