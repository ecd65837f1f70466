"""MinHash near-dedup by a signature-coordinate inverted join.

Documents with the same shingle set form a class; only classes go on, so copies never meet. Every
class is posted under each of its ``COORDINATES`` (coordinate, minimum) pairs. A pair that nobody
else has cannot match and is dropped; the others are ordered by how many classes hold them, rarest
first. Two classes agree on at least ``matches`` coordinates only if they share one of the first
``n - matches + 1`` live pairs of either (prefix), and a class with fewer live pairs than
``matches`` is skipped altogether. In a list of postings, agreeing coordinates are counted for
all members at once; a pair is retained above the threshold, by the list of its first common
pair alone, so no pair is counted twice.

Retained pairs are confirmed on the full shingle sets. Short lists emit their pairs, which meet
the sets by a join. Long lists (a mass of near copies) would emit the square of their length;
their members travel with their sets in square blocks instead, are confirmed right there, and a
block emits only the links of a spanning forest, at most one per member. No link is lost:
components come out the same. Components are found by label contraction over links, each round
a written table.

``matches`` is set so that a true link is missed by its signatures with a probability below
``MISS`` (each link by itself). Defined cases: null or empty text has no shingles and is linked
with nothing; a text of fewer words than a shingle is one shingle; rows with equal sets are linked
whatever their ids; a null id never becomes a component's id unless all its ids are null; an empty
table stays empty. Result columns replace columns of the same name.
"""
from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, others, quoted, stored, text_slices

SHINGLE = 5
#: Similarity as a ratio of integers, compared exactly.
SIMILARITY = (80, 100)
COORDINATES = 24
MISS = 1e-6
#: Longer lists are confirmed in blocks of BLOCK members.
LONG_LIST = 48
BLOCK = 512

#: A-Z to lower case and white space to spaces; only ASCII bytes change.
_TABLE = bytes(32 if 9 <= c <= 13 else c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Pairs of short lists compared at once.
PAIRS = 100_000
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _shingles(v: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` neighbouring word hashes."""
    n = len(v) - size + 1
    out = np.full(max(n, 0), _U(size))
    for k in range(size):
        out = _mix(out * _U(0x9E3779B97F4A7C15) + v[k:k + len(out)])
    return out


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Of each text the sorted 64-bit hashes of its distinct shingles; words are parted by ASCII white space."""
    plain = [(t or "").encode().translate(_TABLE) for t in texts.to_pylist()]
    lists = pc.split_pattern(pa.array(plain, pa.binary()).view(pa.string()), " ")
    words = lists.flatten()
    coded = words.dictionary_encode()
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()], dtype=np.uint64)
    keep = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    ends = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])]
    v = hashes[coded.indices.to_numpy()][keep] if len(hashes) else np.zeros(0, np.uint64)
    windows = _shingles(v, size)
    return [np.unique(windows[a:b - size + 1] if b - a >= size else _shingles(v[a:b], max(b - a, 1)) if b > a else v[:0])
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def shingle_set(text: str | None, size: int) -> np.ndarray:
    return shingle_sets(pa.array([text], pa.string()), size)[0]


@lru_cache
def _factors(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    k = np.arange(1, 2 * coordinates + 1, dtype=np.uint64)
    r = _mix(k * _U(0x9E3779B97F4A7C15))
    return r[:coordinates] | _U(1), r[coordinates:]


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """Of each set, none empty, the minimum of every hash function."""
    a, b = _factors(coordinates)
    out = np.empty((len(sets), coordinates), dtype=np.uint64)
    if sets:
        flat = np.concatenate(sets)
        first = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
        for j in range(coordinates):
            h = flat * a[j] + b[j]
            h ^= h >> _U(32)
            out[:, j] = np.minimum.reduceat(h, first)
    return out


def needed_matches(coordinates: int, similarity: float, miss: float) -> int:
    """The largest threshold that a pair of that similarity misses with at most that probability."""
    below, t = 0.0, 0
    while t < coordinates:
        below += math.comb(coordinates, t) * similarity**t * (1 - similarity) ** (coordinates - t)
        if below > miss:
            break
        t += 1
    return max(1, t)


def linked(a: np.ndarray, b: np.ndarray, similarity: tuple[int, int]) -> bool:
    """Exactly: |a & b| / |a | b| >= p / q."""
    p, q = similarity
    if q * min(len(a), len(b)) < p * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return q * common >= p * (len(a) + len(b) - common)


class _Forest:
    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def _agreeing(sig_a, live_a, sig_b, live_b, rank: int, matches: int, upper: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two blocks that agree on enough coordinates and whose first common live pair has this
    list's rank. ``live``: the rank (class count, coordinate) of each coordinate's pair."""
    count = np.zeros((len(sig_a), len(sig_b)), np.uint8)
    first = np.full(count.shape, np.iinfo(np.int64).max)
    for j in range(sig_a.shape[1]):
        same = sig_a[:, j][:, None] == sig_b[:, j][None, :]
        count += same
        np.minimum(first, np.where(same, live_a[:, j][:, None], np.iinfo(np.int64).max), out=first)
    good = (count >= matches) & (first == rank)
    if upper:
        good = np.triu(good, 1)
    return np.nonzero(good)


def shingled(docs: DataFrame, shingle: int, coordinates: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, cls, sig): cls is a 128-bit digest of the set, null without shingles."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text", 4 << 20):
                sets = shingle_sets(part.column("text"), shingle)
                full = [i for i, s in enumerate(sets) if len(s)]
                sig: list[bytes | None] = [None] * len(sets)
                for i, row in zip(full, signatures([sets[i] for i in full], coordinates), strict=True):
                    sig[i] = row.tobytes()
                cls = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(cls, pa.binary()), pa.array(sig, pa.binary())],
                                                 names=["id", "n_shingles", "cls", "sig"])

    slim = docs.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).alias("text"))
    return slim.mapInArrow(run, "id long, n_shingles long, cls binary, sig binary")


def candidate_classes(classes: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """(cls, sig, ranks, prefix): classes with enough live pairs, the rank of each coordinate's pair
    (class count * 64 + coordinate) and the ranks' prefix."""

    def explode(batches):
        for batch in batches:
            cls = batch.column("cls").to_pylist()
            sig = batch.column("sig").to_pylist()
            flat = np.frombuffer(b"".join(sig), np.uint64).astype(np.int64)
            j = np.tile(np.arange(coordinates, dtype=np.int32), len(cls))
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.binary()).take(pa.array(np.repeat(np.arange(len(cls)), coordinates))),
                                              pa.array(j), pa.array(flat)], names=["cls", "j", "v"])

    pairs = classes.select("cls", "sig").mapInArrow(explode, "cls binary, j int, v long")
    held = pairs.groupBy("j", "v").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Equi-join of thin rows; adaptive execution splits the rows of a hot pair.
    live = pairs.join(held, ["j", "v"])
    per = live.groupBy("cls").agg(F.array_sort(F.collect_list(F.struct((F.col("n") * 64 + F.col("j")).alias("rank"), "j", "v"))).alias("live"))
    per = per.filter(F.size("live") >= matches)
    return per.select("cls", F.slice("live", 1, F.size("live") - (matches - 1)).alias("prefix"), "live")


def links(docs: DataFrame, rows: DataFrame, shingle: int, similarity: tuple[int, int], coordinates: int = COORDINATES,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a, b): links between classes that connect the same components as all links do."""
    matches = needed_matches(coordinates, similarity[0] / similarity[1], MISS)
    classes = rows.filter("cls IS NOT NULL").groupBy("cls").agg(F.first("sig").alias("sig"))
    cand = candidate_classes(classes, coordinates, matches)

    def pack(batches):
        for batch in batches:
            live = batch.column("live")
            ranks = np.full((batch.num_rows, coordinates), np.iinfo(np.int64).max)
            flat = live.flatten()
            row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(live).to_numpy())
            ranks[row, flat.field("j").to_numpy()] = flat.field("rank").to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column("cls"), batch.column("sig"), pa.array([r.tobytes() for r in ranks], pa.binary()), batch.column("prefix")],
                                             names=["cls", "sig", "ranks", "prefix"])

    cand = cand.join(classes, "cls").select("cls", "sig", "live", "prefix")
    cand = stored(cand.mapInArrow(pack, "cls binary, sig binary, ranks binary, prefix array<struct<rank: long, j: int, v: long>>"), "near-candidates")
    # One text for each candidate class, of the smallest id that has it.
    known = F.coalesce(F.col("id"), F.lit(NULL_ID))
    ids = rows.join(cand.select("cls"), "cls", "left_semi").groupBy("cls").agg(F.min(known).alias("_id")).select("_id").distinct()
    texts = docs.select(F.coalesce(quoted(id_col).cast("long"), F.lit(NULL_ID)).alias("_id"), quoted(text_col).alias("text")).join(ids, "_id", "left_semi")

    def sets_of(batches):
        for batch in batches:
            for part in text_slices(batch, "text", 4 << 20):
                sets = shingle_sets(part.column("text"), shingle)
                yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                                                  pa.array([s.tobytes() for s in sets], pa.binary())], names=["cls", "set"])

    sets = texts.mapInArrow(sets_of, "cls binary, set binary").join(cand.select("cls"), "cls", "left_semi").dropDuplicates(["cls"])
    sets = stored(sets, "near-sets")
    postings = cand.select("cls", "sig", "ranks", F.explode("prefix").alias("p"))
    postings = postings.select("cls", "sig", "ranks", F.col("p.j").alias("j"), F.col("p.v").alias("v"), F.col("p.rank").alias("rank"))
    sizes = cand.select(F.explode("prefix").alias("p")).groupBy(F.col("p.j").alias("j"), F.col("p.v").alias("v")).agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    postings = stored(postings.join(sizes, ["j", "v"]), "near-postings")
    short, long = postings.filter(F.col("members") <= LONG_LIST), postings.filter(F.col("members") > LONG_LIST)

    def read(column):
        return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, coordinates)

    def pairs_of(lists):
        """Pairs within whole lists, one after the other: those a given distance apart at a time."""
        j, v = lists.column("j").to_numpy(), lists.column("v").to_numpy()
        edge = np.append(np.flatnonzero((j[1:] != j[:-1]) | (v[1:] != v[:-1])) + 1, len(j))
        stop = edge[np.searchsorted(edge, np.arange(len(j)), side="right")]
        sig, ranks, rank, cls = read(lists.column("sig")), read(lists.column("ranks")).view(np.int64), lists.column("rank").to_numpy(), lists.column("cls")
        for d in range(1, LONG_LIST):
            every = np.flatnonzero(np.arange(len(j)) + d < stop)
            for at in range(0, len(every), PAIRS):
                x = every[at:at + PAIRS]
                same = sig[x] == sig[x + d]
                first = np.where(same, ranks[x], np.iinfo(np.int64).max).min(axis=1)
                x = x[(same.sum(axis=1) >= matches) & (first == rank[x])]
                if len(x):
                    yield pa.RecordBatch.from_arrays([cls.take(pa.array(x)), cls.take(pa.array(x + d))], names=["a", "b"])

    def list_pairs(batches):
        held = None  # the rows of a list that the next batch may go on with
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            j, v = rows.column("j").to_numpy(), rows.column("v").to_numpy()
            open_ = int(np.argmax((j == j[-1]) & (v == v[-1])))
            held = rows.slice(open_)
            if open_:
                yield from pairs_of(rows.slice(0, open_))
        if held is not None:
            yield from pairs_of(held)

    in_lists = short.select("j", "v", "cls", "sig", "ranks", "rank").repartition("j", "v").sortWithinPartitions("j", "v")
    pairs = in_lists.mapInArrow(list_pairs, "a binary, b binary")

    def confirm(batches):
        for batch in batches:
            keep = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), similarity)
                    for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_sets = (pairs.join(sets.select(F.col("cls").alias("a"), F.col("set").alias("x")), "a")
                 .join(sets.select(F.col("cls").alias("b"), F.col("set").alias("y")), "b").select("a", "b", "x", "y"))
    found = with_sets.mapInArrow(confirm, "a binary, b binary")

    # Long lists: square blocks of members with their sets.
    chunks = F.ceil(F.col("members") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("cls"), F.col("chunks")).cast("int")
    blocked = long.withColumn("chunks", chunks).withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    blocked = blocked.withColumn("low", F.least("mine", "other")).withColumn("high", F.greatest("mine", "other"))
    blocked = blocked.join(sets, "cls").select("j", "v", "low", "high", "mine", "cls", "sig", "ranks", "rank", "set")

    def block_links(table):
        group = table.select(["low", "high", "mine", "cls", "rank", "set"]).to_pydict()
        sig, live = read(table.column("sig")), read(table.column("ranks")).view(np.int64)
        sets_ = [np.frombuffer(x, np.uint64) for x in group["set"]]
        low = np.array(group["mine"]) == group["low"][0]
        rows_a, rows_b = np.nonzero(low)[0], np.nonzero(~low if group["low"][0] != group["high"][0] else low)[0]
        forest, out_a, out_b, cls = _Forest(len(sets_)), [], [], group["cls"]
        a, b = _agreeing(sig[rows_a], live[rows_a], sig[rows_b], live[rows_b], group["rank"][0], matches, group["low"][0] == group["high"][0])
        for x, y in zip(rows_a[a].tolist(), rows_b[b].tolist(), strict=True):
            if forest.find(x) != forest.find(y) and linked(sets_[x], sets_[y], similarity):
                forest.join(x, y)
                out_a.append(cls[x])
                out_b.append(cls[y])
        return pa.table({"a": pa.array(out_a, pa.binary()), "b": pa.array(out_b, pa.binary())})

    found = found.unionByName(blocked.groupBy("j", "v", "low", "high").applyInArrow(block_links, "a binary, b binary"))
    return stored(found, "near-links")


def components(edges: DataFrame) -> DataFrame:
    """(cls, root) of every end of an edge: large stars and small stars in turn, each a written
    table, until every end hangs on the smallest of its component."""
    edges = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "stars")
    # The edges as a set, told by their number and the sum of their hashes.
    measure = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
    before = measure(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(small_least, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                                                       F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").filter("u <> v").distinct())
        edges = stored(small, "stars")
        now = measure(edges)
        if now == before:
            break
        before = now
    ends = edges.select(F.col("u").alias("cls"), F.col("v").alias("root"))
    return ends.unionByName(edges.select(F.col("v").alias("cls"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, similarity: tuple[int, int] = SIMILARITY,
                    coordinates: int = COORDINATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable by links) and kept, per row."""
    rows = stored(shingled(docs, shingle, coordinates, id_col, text_col), "near-signatures")
    roots = components(links(docs, rows, shingle, similarity, coordinates, id_col, text_col))
    least = rows.filter("cls IS NOT NULL").groupBy("cls").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
    labelled = least.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    best = labelled.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("copies").alias("size"))
    # Rows alone in their component need no look-up; the others are joined by class, hot ones split.
    wanted = stored(labelled.join(best.filter("size > 1"), "root").select("cls", "component_id"), "near-components")
    out = rows.select("id", "n_shingles", "cls").join(wanted, "cls", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, similarity: tuple[int, int] = SIMILARITY,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id stands for its component; rows that share an id stay or go together."""
    found = near_duplicates(docs, shingle, similarity, id_col=id_col, text_col=text_col)
    # Written first, so that its size is known and a short list need not move the texts.
    gone = stored(found.groupBy(id_col).agg(F.max("kept").alias("_kept")).filter(~F.col("_kept")).select(F.col(id_col).alias("_gone")), "near-gone")
    return docs.join(gone, quoted(id_col).eqNullSafe(F.col("_gone")), "left_anti").select(*[quoted(c) for c in others(docs)])
