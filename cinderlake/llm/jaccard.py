"""Exact Jaccard join of word n-gram sets by prefix trees, up to connected components.

1. A text becomes its set of hashed shingles (64 bits each) and the 128-bit key of that set. Equal
   sets are one set from here on, represented by their smallest doc_id.
2. Shingles are ordered, rare ones first. Two sets that link share a shingle among the first
   ``s - ceil(t*s) + 1`` of each. Holders of a shared prefix shingle are compared by size and by a
   parity bitmap of their shingles: the bits in which two bitmaps differ are no more than the
   shingles in which the sets differ, so no link is lost, and unrelated sets that
   happen to share a shingle part here. What is left connects sets into families, and
   whatever links lies inside one family. A shingle with very many holders is cut into
   blocks, and each pair of blocks is a group of its own.
3. The texts of a family's sets move once, to one task, which stores the sets in a prefix tree,
   common shingles first, so that sets with the same beginning share one overlap count. Many sets
   walk the tree at once; a subtree is left when the overlap so far and what can still
   come on either side are too few for its smallest set, or when all that lies below is linked with
   the walking set already. A family above FAMILY_SHINGLES is cut into blocks, and
   each pair of blocks is joined in a task of its own.
4. Links that join components inside a task are the edges of the last component search.

The order of shingles is exact only for those that are common in some batch of documents; it steers
how much work there is, never which links are found.

Defined results: NULL, empty and blank texts have no shingles and link with nothing; fewer words than
n are one shingle; rows without a doc_id take no part and get a NULL component; rows that repeat
an id are one document with several texts; an empty table gives an empty table; only doc_id
and text are looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinderlake.llm.common import (
    BROADCAST_ROWS,
    Interner,
    blocks_of,
    ragged,
    released,
    rows_of,
    text_bytes,
    words,
)
from cinderlake.llm.components import connected_components
from cinderlake.workspace import materialize

FAMILY_SHINGLES = 500_000
HOLDERS = 4096
# No more holders of one shingle go through a window together; with more it counts as common.
HELD_TOGETHER = 100_000
# Bound of what steers the order of shingles.
COMMON_SHINGLES = 1 << 17
_COMMON_IN_BATCH = 3
_CELLS = 1 << 21
_WALKERS = 64
_PAIRS_AT_ONCE = 1 << 17
_ROWS_AT_ONCE = 1 << 19
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _word_id(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def shingle_set(text: bytes, n: int, known: Interner) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    found = words(text)
    if not found:
        return np.zeros(0, np.uint64)
    ids = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    width = min(n, len(ids))
    hashes = np.full(len(ids) - width + 1, width, np.uint64)
    for i in range(width):
        hashes = (hashes * _PRIME) ^ ids[i : len(ids) - width + 1 + i]
        hashes ^= hashes >> np.uint64(29)
        hashes *= _MIX
    return np.unique(hashes)


def _set_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def bitmap(shingles: np.ndarray, num: int, den: int) -> bytes:
    """One bit per residue of the hashes: whether an odd number of shingles has it.

    Four times as many bits as shingles in which sets of this size may differ and still link, so that the
    bitmaps of unrelated sets differ in about twice as many; a power of two from 128 to
    8192. A longer bitmap folds to a shorter one.
    """
    if not len(shingles):
        return b""
    wanted = 8 * len(shingles) * (den - num) // (den + num)
    width = min(max(128, 1 << wanted.bit_length()), 8192)
    place = ((shingles >> np.uint64(20)) & np.uint64(width - 1)).astype(np.int64)
    odd = (np.bincount(place, minlength=width) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").tobytes()


def _folded(bitmaps: list[bytes], words: int) -> np.ndarray:
    """Bitmaps as rows of ``words`` 64-bit words; none may be shorter."""
    out = np.zeros((len(bitmaps), words), np.uint64)
    lengths = np.array([len(b) for b in bitmaps]) // 8
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        data = np.frombuffer(b"".join(bitmaps[i] for i in rows), np.uint64)
        out[rows] = np.bitwise_xor.reduce(data.reshape(len(rows), n // words, words), axis=1)
    return out


def _joined_labels(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Labels, each the smallest row of its component, after joining rows ``x`` with rows ``y``."""
    while True:
        a, b = label[x], label[y]
        apart = a != b
        if not apart.any():
            return label
        # Labels are roots here, so hanging a root below another takes along all its rows.
        np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (label[label] != label).any():
            label = label[label]


def connect_holders(
    group: np.ndarray, own: np.ndarray, mixed: np.ndarray, node: np.ndarray, size: np.ndarray,
    bitmaps: list[bytes], num: int, den: int,
) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what may link within each group.

    Rows of a group stand together. Where ``mixed`` is true only rows of unlike ``own`` are compared.
    """
    rows = len(group)
    ends = np.searchsorted(group, group, "right")
    partners = ends - np.arange(rows) - 1
    label, words = np.arange(rows), np.array([len(b) for b in bitmaps]) // 8
    upto = np.cumsum(partners)
    first = 0
    while first < rows:
        done = upto[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(upto, done + _PAIRS_AT_ONCE, "right")))
        some = np.arange(first, last)
        first = last
        left = np.repeat(some, partners[some])
        right = ragged(some + 1, partners[some])
        may = (label[left] != label[right]) & (node[left] != node[right])
        may &= ~mixed[left] | (own[left] != own[right])
        small, large = np.minimum(size[left], size[right]), np.maximum(size[left], size[right])
        may &= small * den >= large * num
        left, right = left[may], right[may]
        narrow = np.minimum(words[left], words[right])
        for n in np.unique(narrow):
            at = np.flatnonzero(narrow == n)
            used, place = np.unique(np.concatenate([left[at], right[at]]), return_inverse=True)
            bits = _folded([bitmaps[i] for i in used], int(n))
            for part in range(0, len(at), _ROWS_AT_ONCE // int(n) + 1):
                p = np.arange(part, min(part + _ROWS_AT_ONCE // int(n) + 1, len(at)))
                unlike = np.bitwise_count(bits[place[p]] ^ bits[place[p + len(at)]])
                x, y = left[at[p]], right[at[p]]
                near = unlike.sum(axis=1, dtype=np.int64) * (den + num) <= (den - num) * (
                    size[x] + size[y]
                )
                x, y = x[near], y[near]
                label = _joined_labels(label, x, y)
    joined = np.flatnonzero(label != np.arange(rows))
    return node[joined], node[label[joined]]


def _signatures(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """A row per document (id, n_shingles, set_key, node), and rows (token, seen) of common shingles."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()),
         ("node", pa.int64()), ("bitmap", pa.binary()), ("token", pa.int64()),
         ("seen", pa.int64())]
    )

    def run(batches):
        known = Interner(_word_id)
        for block in blocks_of(batches, lambda r: len(r[1]), "doc_id", "text"):
            sets = [shingle_set(t, n, known) for _, t in block]
            keys = [_set_key(s) if len(s) else None for s in sets]
            nodes = [int.from_bytes(k[:8], "little", signed=True) if k else None for k in keys]
            distinct = {k: s for k, s in zip(keys, sets, strict=True) if k}
            tokens, seen = np.unique(
                np.concatenate([np.zeros(0, np.uint64), *distinct.values()]), return_counts=True
            )
            common = seen >= _COMMON_IN_BATCH
            tokens, seen = _signed(tokens[common]), seen[common]
            d, c = len(block), len(tokens)
            none = [None]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i for i, _ in block] + none * c, pa.int64()),
                    pa.array([len(s) for s in sets] + none * c, pa.int64()),
                    pa.array(keys + none * c, pa.binary()),
                    pa.array(nodes + none * c, pa.int64()),
                    pa.array([bitmap(s, num, den) for s in sets] + none * c, pa.binary()),
                    pa.array(none * d + tokens.tolist(), pa.int64()),
                    pa.array(none * d + seen.tolist(), pa.int64()),
                ],
                schema=schema,
            )

    return docs.select("doc_id", text_bytes()).mapInArrow(
        released(run),
        "doc_id long, n_shingles long, set_key binary, node long, bitmap binary, token long, "
        "seen long",
    )


def _order(signatures: DataFrame) -> np.ndarray:
    """The most common shingles, sorted, with their rank by frequency in a second row."""
    top = (
        signatures.where("token IS NOT NULL").groupBy("token").agg(F.sum("seen").alias("seen"))
        .orderBy(F.desc("seen"), "token").limit(COMMON_SHINGLES).select("token").collect()
    )
    tokens = np.array([r.token for r in top], np.int64).view(np.uint64)
    by_value = np.argsort(tokens)
    # The most common one has the highest rank and so comes last in a set.
    return np.stack([tokens[by_value], (len(tokens) - by_value).astype(np.uint64)])


def prefix_length(size: int, num: int, den: int) -> int:
    return size - -(-size * num // den) + 1


def _postings(docs: DataFrame, n: int, num: int, den: int, order: np.ndarray) -> DataFrame:
    """token, node, size, common: the prefix of each set, once per task and set."""
    shared = docs.sparkSession.sparkContext.broadcast(order)
    schema = pa.schema(
        [("token", pa.int64()), ("node", pa.int64()), ("size", pa.int32()), ("common", pa.bool_())]
    )

    def run(batches):
        known, (common, rank) = Interner(_word_id), shared.value
        met: set[bytes] = set()
        for block in blocks_of(batches, lambda r: len(r[0]), "text"):
            tokens, nodes, sizes, commons = [], [], [], []
            for (text,) in block:
                own = shingle_set(text, n, known)
                key = _set_key(own)
                if not len(own) or key in met:
                    continue
                if len(met) > 500_000:
                    met.clear()
                met.add(key)
                score = own >> np.uint64(1)
                if len(common):
                    place = np.searchsorted(common, own)
                    place[place == len(common)] = 0
                    high = np.uint64(1 << 63) | rank[place]
                    score = np.where(common[place] == own, high, score)
                first = np.argsort(score, kind="stable")[: prefix_length(len(own), num, den)]
                tokens.append(own[first])
                commons.append(score[first] >= np.uint64(1 << 63))
                sizes.append(np.full(len(first), len(own), np.int32))
                nodes.append(np.full(len(first), int.from_bytes(key[:8], "little", signed=True)))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(_signed(np.concatenate(tokens))),
                        pa.array(np.concatenate(nodes), pa.int64()),
                        pa.array(np.concatenate(sizes)),
                        pa.array(np.concatenate(commons)),
                    ],
                    schema=schema,
                )

    return docs.select(text_bytes()).mapInArrow(
        released(run), "token long, node long, size int, common boolean"
    )


def _candidate_edges(
    postings: DataFrame, sets: DataFrame, num: int, den: int, holders: int
) -> DataFrame:
    """Edges (a, b) that connect all sets that share a prefix shingle and may link.

    A holder of a rare shingle stays if the next smaller or larger holder is near enough in size; that
    drops most holders, which share a shingle by chance, from a narrow table. A shingle that more
    than one set in COMMON_SHINGLES / (mean size of a set) holds is a common one, and so is one with
    more than HELD_TOGETHER holders; those are counted by aggregates and may go on in blocks. Only what is left is joined with
    bitmaps. Groups go through in sorted order, many at a time.
    """
    # Partial counts of the tasks tell which shingles of the rare ones have very many holders.
    many = postings.where("NOT common").groupBy("token").agg(F.count("*").alias("n"))
    many = materialize(many.where(F.col("n") > HELD_TOGETHER).select("token"), "held-by-many")
    hot = many.count()
    if hot:
        side = F.broadcast(many) if hot <= BROADCAST_ROWS else many
        marked = postings.join(side.withColumn("hot", F.lit(True)), "token", "left")
        common = F.col("common") | F.col("hot").isNotNull()
        postings = marked.select("token", "node", "size", common.alias("common"))
    by_token = Window.partitionBy("token")
    by_size = by_token.orderBy("size", "node")
    smaller, larger = F.lag("size").over(by_size), F.lead("size").over(by_size)
    rare = postings.where("NOT common").select(
        "token", "node", "size",
        ((smaller * den >= F.col("size") * num) & (F.lag("node").over(by_size) != F.col("node")))
        .alias("below"),
        ((F.col("size") * den >= larger * num) & (F.lead("node").over(by_size) != F.col("node")))
        .alias("above"),
        F.count("*").over(by_token).alias("n"),
    )
    rare = rare.where("below OR above").select("token", "node", "size", "n")
    common = postings.where("common")
    counts = common.groupBy("token").agg(
        F.count("*").alias("n"), F.min("node").alias("x"), F.max("node").alias("y")
    )
    # At most COMMON_SHINGLES rows of two numbers, and those that are held by many.
    counts = counts.where("x < y").select("token", "n")
    if hot <= BROADCAST_ROWS:
        counts = F.broadcast(counts)
    common = common.join(counts, "token").select("token", "node", "size", "n")
    alive = rare.unionByName(common).withColumn(
        "m", F.ceil(F.col("n") / holders).cast("int")
    ).drop("n")
    found = alive.join(sets.select("node", "bitmap"), "node")
    found = found.withColumn("own", F.pmod(F.xxhash64("node"), F.col("m")).cast("int"))
    found = found.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    found = found.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")})
    keys = ["token", "lo", "hi"]
    found = found.select(*keys, "own", "node", "size", "bitmap")
    found = found.repartition(*keys).sortWithinPartitions(*keys)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        held: pa.Table | None = None

        def edges(rows: pa.Table) -> pa.RecordBatch:
            token, lo, hi, own, node, size = (
                rows.column(c).to_numpy() for c in ("token", "lo", "hi", "own", "node", "size")
            )
            new = (np.diff(token) != 0) | (np.diff(lo) != 0) | (np.diff(hi) != 0)
            group = np.concatenate([[0], np.cumsum(new)])
            a, b = connect_holders(
                group, own, lo != hi, node, size, rows.column("bitmap").to_pylist(), num, den
            )
            pairs = np.unique(np.stack([a, b], axis=1), axis=0) if len(a) else np.zeros((0, 2), int)
            return pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())],
                schema=schema,
            )

        for batch in batches:
            if not len(batch):
                continue
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            # The last group may go on in the next batch.
            same = np.ones(len(held), bool)
            for c in keys:
                column = held.column(c).to_numpy()
                same &= column == column[-1]
            whole = int(np.flatnonzero(same)[0])
            if whole:
                yield edges(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None:
            yield edges(held)

    return found.mapInArrow(released(run), "a long, b long").distinct()


class PrefixTree:
    """Sets of token ranks in a prefix tree with unbranched paths drawn together."""

    def __init__(self, sets: list[np.ndarray]):
        """``sets``: sorted, distinct, non-empty rank arrays, in lexicographic order."""
        self.sets, self.sizes = sets, np.array([len(s) for s in sets])
        shared = np.zeros(len(sets), np.int64)
        for i in range(1, len(sets)):
            a, b = sets[i - 1], sets[i]
            k = min(len(a), len(b))
            differ = np.flatnonzero(a[:k] != b[:k])
            shared[i] = differ[0] if len(differ) else k
        nodes: list[tuple] = []  # parent, level, first set, end set, first token, end token
        waiting = [(-1, 0, 0, len(sets), 0)]
        while waiting:
            parent, level, lo, hi, depth = waiting.pop()
            end = int(shared[lo + 1 : hi].min()) if hi - lo > 1 else len(sets[lo])
            me = len(nodes)
            nodes.append((parent, level, lo, hi, depth, end))
            if hi - lo > 1:
                splits = [lo, *(np.flatnonzero(shared[lo + 1 : hi] == end) + lo + 1).tolist(), hi]
                if len(sets[lo]) == end:  # this set ends here; the others go on
                    splits = splits[1:]
                waiting.extend(
                    (me, level + 1, a, b, end) for a, b in zip(splits, splits[1:], strict=False)
                )
        table = np.array(nodes, np.int64)
        self.parent, self.level, self.lo, self.hi, self.start, self.end = table.T
        self.ends_set = np.where(self.sizes[self.lo] == self.end, self.lo, -1)
        self.largest = np.array(
            [self.sizes[a:b].max() for a, b in zip(self.lo, self.hi, strict=True)]
        )
        self.smallest = np.array(
            [self.sizes[a:b].min() for a, b in zip(self.lo, self.hi, strict=True)]
        )
        self.levels = [np.flatnonzero(self.level == k) for k in range(self.level.max() + 1)]

    def links(self, vocabulary: int, num: int, den: int) -> list[tuple[int, int]]:
        """Pairs of sets with Jaccard >= num/den, as many as connect all that such pairs connect."""
        count = len(self.sets)
        label = np.arange(count)
        found: list[tuple[int, int]] = []
        step = max(1, min(_WALKERS, _CELLS // max(1, vocabulary)))
        at_last = np.array(
            [self.sets[a][e - 1] if e else -1 for a, e in zip(self.lo, self.end, strict=True)]
        )
        for first in range(0, count, step):
            walkers = np.arange(first, min(first + step, count))
            member = np.zeros((vocabulary, len(walkers)), np.int32)
            for k, w in enumerate(walkers):
                member[self.sets[w], k] = 1
            until = np.cumsum(member, axis=0, dtype=np.int32)
            size = self.sizes[walkers]
            changes = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])])
            uniform = changes[self.hi - 1] == changes[self.lo]
            linked: list[list[np.ndarray]] = [[] for _ in walkers]
            row_of = np.full(len(self.parent), -1)
            before = np.zeros((1, len(walkers)), np.int32)
            for nodes in self.levels:
                if self.level[nodes[0]]:
                    nodes = nodes[row_of[self.parent[nodes]] >= 0]
                    if not len(nodes):
                        break
                    overlap = before[row_of[self.parent[nodes]]]
                else:
                    overlap = np.zeros((1, len(walkers)), np.int32)
                overlap = overlap + self._segment_sums(nodes, member)
                own_left = (self.largest[nodes] - self.end[nodes])[:, None]
                last = at_last[nodes]
                left = np.where(last[:, None] >= 0, size - until[last], size)
                most = overlap + np.minimum(own_left, left)
                alive = (num + den) * most >= num * (size + self.smallest[nodes][:, None])
                alive &= self.largest[nodes][:, None] * den >= num * size
                alive &= self.smallest[nodes][:, None] * num <= den * size
                alive &= self.hi[nodes][:, None] > walkers + 1
                alive &= ~(
                    uniform[nodes][:, None] & (label[self.lo[nodes]][:, None] == label[walkers])
                )
                here = self.ends_set[nodes]
                hit = alive & (here >= 0)[:, None] & (here[:, None] > walkers)
                hit &= (num + den) * overlap >= num * (size + self.sizes[here][:, None])
                for k in np.flatnonzero(hit.any(axis=0)):
                    linked[k].append(here[hit[:, k]])
                keep = alive.any(axis=1)
                row_of[nodes[keep]] = np.arange(keep.sum())
                before = overlap[keep]
            for w, parts in zip(walkers.tolist(), linked, strict=True):
                if parts:
                    others = np.concatenate(parts)
                    labels, one_of = np.unique(label[others], return_index=True)
                    new = labels != label[w]
                    found.extend((w, int(others[i])) for i in one_of[new])
                    if new.any():
                        label[np.isin(label, labels)] = label[w]
            if (label == label[0]).all():
                break
        return found

    def _segment_sums(self, nodes: np.ndarray, member: np.ndarray) -> np.ndarray:
        """How many tokens of each node's path segment each walker has."""
        sums = np.zeros((len(nodes), member.shape[1]), np.int32)
        most = max(1, _CELLS // member.shape[1])
        part: list[np.ndarray] = []
        rows: list[int] = []
        held = 0

        def settle() -> None:
            if rows:
                starts = np.concatenate([[0], np.cumsum([len(p) for p in part])[:-1]])
                sums[rows] += np.add.reduceat(member[np.concatenate(part)], starts, axis=0)
            part.clear()
            rows.clear()

        for i, node in enumerate(nodes):
            tokens = self.sets[self.lo[node]][self.start[node] : self.end[node]]
            for at in range(0, len(tokens), most):
                piece = tokens[at : at + most]
                if held + len(piece) > most or (rows and rows[-1] == i):
                    settle()
                    held = 0
                part.append(piece)
                rows.append(i)
                held += len(piece)
        settle()
        return sums


def linking_pairs(sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """Pairs of positions that link and connect all that links connect. ``sets`` are distinct."""
    if len(sets) < 2:
        return []
    tokens, place, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(tokens), np.int64)
    rank[np.lexsort((tokens, -seen))] = np.arange(len(tokens))
    bounds = np.cumsum([len(s) for s in sets])[:-1]
    ranked = [np.sort(r) for r in np.split(rank[place], bounds)]
    order = sorted(range(len(sets)), key=lambda i: ranked[i].astype(">u4").tobytes())
    tree = PrefixTree([ranked[i] for i in order])
    return [(order[a], order[b]) for a, b in tree.links(len(tokens), num, den)]


def _family_links(members: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Links (a, b) between representatives, from rows (family, lo, hi, rep, set_key, text)."""

    def join(rows: pa.Table) -> pa.Table:
        known = Interner(_word_id)
        sets: dict[bytes, tuple[int, np.ndarray]] = {}
        for rep, key, text in rows_of(rows.to_batches(), "rep", "set_key", "text"):
            if key not in sets:
                own = shingle_set(text, n, known)
                if _set_key(own) == key:
                    sets[key] = (rep, own)
        reps = [r for r, _ in sets.values()]
        pairs = linking_pairs([s for _, s in sets.values()], num, den)
        return pa.table(
            {
                "a": pa.array([reps[i] for i, _ in pairs], pa.int64()),
                "b": pa.array([reps[j] for _, j in pairs], pa.int64()),
            }
        )

    return members.groupBy("family", "lo", "hi").applyInArrow(join, "a long, b long")


def jaccard_components(
    docs: DataFrame, n: int = 5, num: int = 80, den: int = 100,
    family_shingles: int = FAMILY_SHINGLES, holders: int = HOLDERS,
) -> DataFrame:
    """doc_id, n_shingles, component_id: a row per row of ``docs``.

    Documents link when ``den * intersection >= num * union`` of their sets of ``n``-word
    shingles; component_id is the smallest doc_id reachable by links.
    """
    signatures = materialize(_signatures(docs, n, num, den), "signatures")
    each = signatures.where("token IS NULL").select("doc_id", "n_shingles", "set_key")
    order = _order(signatures)
    sets = signatures.where("doc_id IS NOT NULL AND set_key IS NOT NULL").groupBy("set_key").agg(
        F.min("doc_id").alias("rep"), F.first("node").alias("node"),
        F.first("n_shingles").alias("n_shingles"), F.first("bitmap").alias("bitmap"),
    )
    sets = materialize(sets, "sets")
    postings = materialize(_postings(docs, n, num, den, order), "postings")
    edges = _candidate_edges(postings, sets, num, den, holders)
    found = connected_components(edges, "a", "b")
    placed = sets.join(found.withColumnRenamed("node", "node_"), F.col("node") == F.col("node_"), "left")
    placed = placed.select(
        "set_key", "rep", "n_shingles", F.coalesce("component", "node").alias("family")
    )
    families = (
        placed.groupBy("family").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("total"))
        .where("n > 1")
        .select("family", F.ceil(F.col("total") / family_shingles).cast("int").alias("blocks"))
    )
    members = placed.join(families, "family").withColumn(
        "block", F.pmod(F.xxhash64("set_key"), F.col("blocks")).cast("int")
    )
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.select(
        "family", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
        "rep", "set_key",
    )
    members = materialize(members, "members")
    few = members.count() <= BROADCAST_ROWS
    wanted = F.broadcast(members) if few else members
    texts = docs.select("doc_id", text_bytes())
    with_text = texts.join(wanted, F.col("doc_id") == F.col("rep")).drop("doc_id")
    links = connected_components(_family_links(with_text, n, num, den), "a", "b")

    named = sets.select("set_key", "rep").join(links, F.col("rep") == F.col("node"), "left")
    named = named.select("set_key", F.coalesce("component", "rep").alias("component_id"))
    # Adaptive execution splits a set that many rows share; nothing below needs it whole.
    result = each.join(named, "set_key", "left")
    component = F.when(
        F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")
    )
    return result.select("doc_id", "n_shingles", component.alias("component_id"))
