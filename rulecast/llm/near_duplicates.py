"""Near-duplicate documents by chosen paths.

A document is its set of word shingles. Equal sets are folded first. Then independent trees branch
the distinct sets: at each level of a tree a set goes to the node of the token with the smallest
hash under that level's function, and also to that of the second smallest if it lies below
1 / (threshold * set size), so that similar sets keep meeting in some node. A node with few sets is
compared exhaustively by sketches of the minima; a larger one branches on. A node that is still
large at the last level holds sets that agree in several independent minima.

Sets that close sketches or such a node join are a neighbourhood, and every link lies inside one. A
task says of the pairs only what joins its sets, so there are no more rows than sets in nodes. The
texts of a neighbourhood come together once, and its sets are linked by full comparison. One that is
too heavy for a task is dealt by two hashes first; then its nodes are compared, where they hold sets
that are not joined yet.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulecast.llm.common import free_arrow, ship, small_batches, texts
from rulecast.llm.components import connected_components
from rulecast.llm.words import FOLDED, Words, cut, mix, pieces
from rulecast.operators.lineage import materialize

TREES, SMALL_NODE = 12, 64
#: What a task compares in full at once, in shingles, and what a set weighs besides its shingles.
BLOCK, MEMBER = 1 << 20, 128
#: Sets, or rows, that a task holds before it gives them on.
HELD = 100_000
#: Standard deviations by which a sketch may fall short of the threshold.
SLACK = 4.5


def shingle_sets(words: Words, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than ``size`` are one shingle."""
    grams, inside = words.grams(size)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(grams[a:b][inside[a:b]]))
        elif b > a:
            short = np.array([b - a], np.uint64)
            for at in range(a, b):
                short = mix(short * np.uint64(31) + words.hashes[at : at + 1])
            out.append(short)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _functions(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def minima(shingles: np.ndarray, factors: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per hash function the smallest value, the second, and whether the second is chosen too."""
    values = shingles[None, :] * factors[:, None]
    if len(shingles) == 1:
        return values[:, 0] >> np.uint64(32), values[:, 0] >> np.uint64(32), np.zeros(len(factors), bool)
    low = np.partition(values, 1, axis=1)[:, :2] >> np.uint64(32)
    return low[:, 0], low[:, 1], low[:, 1] < np.uint64(min(2**32 - 1, int(2**32 / (threshold * len(shingles)))))


def _sketched(docs: DataFrame, size: int, threshold: float, trees: int, levels: int) -> DataFrame:
    """``doc_id, row, n_shingles, key, low, second, sketch``: the set's digest and its minima, null if empty.

    The sketch has one byte of each minimum.
    """
    factors = _functions(trees * levels)
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary()]

    def sketch(batches):
        for batch in batches:
            for piece in pieces(batch):
                rows = []
                for shingles in shingle_sets(cut(piece.column(1), FOLDED), size):
                    if not len(shingles):
                        rows.append((0, None, None, None, None))
                        continue
                    once, again = mix(shingles), mix(shingles ^ np.uint64(0xA0761D6478BD642F))
                    key = np.array([once.sum(), np.bitwise_xor.reduce(again), again.sum()], np.uint64).tobytes()
                    low, second, chosen = minima(shingles, factors, threshold)
                    second = second.astype(np.uint32).view(np.int32).tolist()
                    rows.append((len(shingles), key, low.astype(np.uint32).view(np.int32).tolist(), [s if c else None for s, c in zip(second, chosen.tolist(), strict=True)], low.astype(np.uint8).tobytes()))
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(2), *columns], names=["doc_id", "row", "n_shingles", "key", "low", "second", "sketch"])
            free_arrow()

    return docs.select("doc_id", "text", "row").mapInArrow(sketch, "doc_id bigint, row bigint, n_shingles bigint, key binary, low array<int>, second array<int>, sketch binary")


def _near(sketch: np.ndarray, sizes: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float, least: float) -> np.ndarray:
    """Which of the pairs have sizes and sketches near enough."""
    small, large = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
    ok = small >= threshold * large - 1e-9
    ok[ok] = (sketch[i[ok]] == sketch[j[ok]]).mean(axis=1) >= least
    return ok


def _groups(batches, key: str):
    """Tables of whole groups from batches that are sorted by ``key``; a group is never torn apart."""
    held: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        values = table[key].to_numpy()
        if held and held[-1][key][-1].as_py() != values[0]:
            yield pa.concat_tables(held).combine_chunks()
            held = []
        start = int(np.searchsorted(values, values[-1]))
        if start:
            yield pa.concat_tables([*held, table.slice(0, start)]).combine_chunks()
            held = []
        held.append(table.slice(start))
    if held:
        yield pa.concat_tables(held).combine_chunks()


def _sketches(column: pa.ChunkedArray) -> np.ndarray:
    joined = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(joined.to_pylist()), np.uint8).reshape(len(joined), -1)


def _root(parent: dict[int, int], x: int) -> int:
    while (up := parent.get(x, x)) != x:
        parent[x] = x = parent.get(up, up)
    return x


def _stars(parent: dict[int, int]) -> pa.RecordBatch:
    """``a, b``: each member of a class but the smallest, with the smallest."""
    members = [x for x, up in parent.items() if x != up]
    return pa.RecordBatch.from_arrays([pa.array([_root(parent, x) for x in members], pa.int64()), pa.array(members, pa.int64())], names=["a", "b"])


def _joined(rows: DataFrame, threshold: float, least: float) -> DataFrame:
    """``a, b``: what joins the sets that close pairs join, fewer rows than sets. Rows: ``node, rep, n, sketch``."""

    def compare(batches):
        parent: dict[int, int] = {}
        for table in _groups(batches, "node"):
            node, rep, n = (table[c].to_numpy() for c in ("node", "rep", "n"))
            sketch = _sketches(table["sketch"])
            for step in range(1, SMALL_NODE):
                i = np.flatnonzero(node[step:] == node[:-step])
                if not len(i):
                    break
                i = i[_near(sketch, n, i, i + step, threshold, least)]
                for x, y in zip(rep[i].tolist(), rep[i + step].tolist(), strict=True):
                    x, y = _root(parent, x), _root(parent, y)
                    parent[max(x, y)] = min(x, y)
            if len(parent) > HELD:
                yield _stars(parent)
                parent = {}
        yield _stars(parent)
        free_arrow()

    return rows.repartition("node").sortWithinPartitions("node").mapInArrow(compare, "a bigint, b bigint")


def linked_labels(sets: list[np.ndarray], label: np.ndarray, percent: int) -> list[list[int]]:
    """The labels that links join, class by class, from sets without repeats and none empty.

    Sets with a common label are in one class already. From each class outwards, a set reached is
    compared with all that are not reached yet and have a size near enough.
    """
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    left, label = sizes[order], label[order]
    ids = np.unique(np.concatenate([sets[k] for k in order.tolist()]), return_inverse=True)[1]
    own = np.split(ids, np.cumsum(left)[:-1])
    mark = np.zeros(int(ids.max()) + 1, bool)
    at, start = np.arange(len(sets)), np.cumsum(left) - left
    out = []
    while len(at):
        reached, ahead, names = label[at[:1]], [], []
        while True:
            if len(reached):
                gone = np.isin(label[at], reached)
                names += np.unique(reached).tolist()
                ahead += at[gone].tolist()
                ids = ids[np.repeat(~gone, left)]
                at, left = at[~gone], left[~gone]
                start = np.cumsum(left) - left
            if not ahead or not len(at):
                break
            mine = own[ahead.pop()]
            a = int(np.searchsorted(left, len(mine) * percent / 100 - 1e-6))
            b = int(np.searchsorted(left, len(mine) * 100 / percent + 1e-6, "right")) if percent else len(left)
            reached = label[:0]
            if a < b:
                mark[mine] = True
                end = start[b] if b < len(start) else len(ids)
                common = np.add.reduceat(mark[ids[start[a] : end]], start[a:b] - start[a], dtype=np.int64)
                mark[mine] = False
                reached = label[at[a:b][100 * common >= percent * (len(mine) + left[a:b] - common)]]
        if len(names) > 1:
            out.append(sorted(names))
    return out


def _linked(members: DataFrame, own: DataFrame, size: int, percent: int) -> DataFrame:
    """``a, b``: labels that links inside a group join. Members: ``group, rep, label, doc_id, row``."""
    # Texts are never few enough to be sent everywhere, and how many members are depends on the corpus.
    told = members.hint("merge").join(own, ["doc_id", "row"]).select("group", "rep", "label", "text")

    def link(batches):
        group = rep = None
        sets: list[np.ndarray] = []
        labels: list[int] = []
        found: list[tuple[int, int]] = []

        def settle():
            if len(sets) > 1:
                for names in linked_labels(sets, np.array(labels), percent):
                    found.extend((names[0], other) for other in names[1:])

        def links():
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            for piece in pieces(batch):
                places = zip(*(piece.column(k).to_pylist() for k in range(3)), strict=True)
                for (its, one, label), shingles in zip(places, shingle_sets(cut(piece.column(3), FOLDED), size), strict=True):
                    if its != group:
                        settle()
                        group, sets, labels = its, [], []
                    elif one == rep:
                        continue
                    rep = one
                    sets.append(shingles)
                    labels.append(label)
                if len(found) > HELD:
                    yield links()
                    found = []
            free_arrow()
        settle()
        yield links()

    return told.repartition("group").sortWithinPartitions("group", "rep").mapInArrow(link, "a bigint, b bigint")


def _dealt_nodes(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """``group, rep, label, doc_id, row``: nodes whose members have different labels, in groups a task can hold.

    One end of a new link has another label than most of its node. Those sets are dealt into blocks
    of their own, all sets into parts, and every block meets every part.
    """
    placed = nodes.join(members, "rep")
    weights = placed.groupBy("node", "label").agg(F.sum("weight").alias("w"))
    shares = weights.groupBy("node").agg(F.sum("w").alias("all"), F.max("w").alias("most"), F.max_by("label", F.struct("w", "label")).alias("usual"))
    counts = [F.ceil(F.col(c) / BLOCK).cast("int").alias(to) for c, to in (("all", "parts"), ("odd", "blocks"))]
    shares = shares.withColumn("odd", F.col("all") - F.col("most")).filter("odd > 0").select("node", "usual", *counts)
    placed = placed.join(shares, "node")

    def spread(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    def place(count: str, seed: int):
        return F.pmod(F.xxhash64("rep", F.lit(seed)), count).cast("int")

    whole = placed.withColumn("part", place("parts", 1)).withColumn("block", spread("blocks"))
    odd = placed.filter("parts > 1 and label <> usual").withColumn("part", spread("parts")).withColumn("block", place("blocks", 2))
    return whole.unionByName(odd).select(F.xxhash64("node", "part", "block").alias("group"), "rep", "label", "doc_id", "row")


def near_duplicate_classes(docs: DataFrame, shingle: int = 5, percent: int = 80, trees: int = TREES, rows: bool = False) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document; with ``rows`` also ``row``, the
    ``xxhash64`` of its text.

    Documents with ``100 * |intersection| >= percent * |union|`` of their sets of ``shingle``-word
    shingles are linked; ``component_id`` is the smallest id reachable, and ``kept`` tells whether
    that is the document itself. A text of fewer words is one shingle; a text without words (also
    a null one) is linked with nothing. Copies are linked through their common set, rows that
    share an id by their own texts; a row with a null id is linked with nothing and kept. Other
    columns are ignored; no rows give no rows. Links are found by ``trees`` independent trees; a
    pair at the threshold is missed by all of 12 with a chance below one in ten thousand, one of
    similarity 0.9 with a negligible one.
    """
    spark = docs.sparkSession
    ship(spark)
    small_batches(spark)
    threshold = percent / 100
    own = texts(docs).withColumn("row", F.xxhash64("text"))
    levels = max(3, math.ceil(math.log(max(2, own.count()) / SMALL_NODE, 20)))
    hashes = trees * levels
    least = threshold - SLACK * math.sqrt(threshold * (1 - threshold) / hashes)
    sketched = materialize(_sketched(own, shingle, threshold, trees, levels))
    known = sketched.filter(F.col("key").isNotNull() & F.col("doc_id").isNotNull())
    # Rows that share an id may have different sets, so a set is known by a number of its own.
    sets = known.groupBy("key").agg(F.min_by(F.struct("doc_id", "row", "n_shingles", "low", "second", "sketch"), F.struct("doc_id", "row")).alias("s"))
    sets = materialize(sets.select(F.monotonically_increasing_id().alias("rep"), "key", "s.doc_id", "s.row", F.col("s.n_shingles").alias("n"), "s.low", "s.second", "s.sketch"))

    def tokens(tree, level: int):
        at = tree * levels + level
        return F.array_compact(F.array(F.get("low", at), F.get("second", at)))

    paths = sets.select("rep", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), "low", "second")
    paths = paths.select("rep", "tree", F.explode(tokens(F.col("tree"), 0)).alias("token")).select("rep", "tree", F.xxhash64("tree", "token").alias("node"))
    small = large = None
    for level in range(1, levels + 1):
        counts = paths.groupBy("node").agg(F.count("*").alias("m")).filter("m > 1")
        sized = materialize(paths.join(counts, "node"))
        few = sized.filter(F.col("m") <= SMALL_NODE).select("node", "rep")
        small = few if small is None else small.unionByName(few)
        large = sized.filter(F.col("m") > SMALL_NODE).select("node", "tree", "rep")
        if level < levels:
            down = large.join(sets.select("rep", "low", "second"), "rep")
            paths = down.select("rep", "tree", "node", F.explode(tokens(F.col("tree"), level)).alias("token"))
            paths = paths.select("rep", "tree", F.xxhash64("node", "token").alias("node"))
    first = large.groupBy("node").agg(F.min("rep").alias("a"))
    stars = large.join(first, "node").filter("rep <> a").select("a", F.col("rep").alias("b"))
    compared = small.join(sets.select("rep", "n", "sketch"), "rep").select("node", "rep", "n", "sketch")
    whole = connected_components(_joined(compared, threshold, least).unionByName(stars)).withColumnRenamed("id", "rep")
    members = materialize(sets.select("rep", "doc_id", "row", (F.col("n") + MEMBER).alias("weight")).join(whole, "rep"))
    parts = members.groupBy("component").agg(F.ceil(F.sum("weight") / BLOCK).cast("int").alias("parts"))
    members = materialize(members.join(parts, "component"))
    deals = members.withColumn("deal", F.explode(F.sequence(F.lit(1), F.least("parts", F.lit(2)))))
    group = F.xxhash64("component", "deal", F.pmod(F.xxhash64("rep", "deal"), "parts")).alias("group")
    links = materialize(_linked(deals.select(group, "rep", F.col("rep").alias("label"), "doc_id", "row"), own, shingle, percent))
    labels = materialize(connected_components(links))
    heavy = members.filter("parts > 1").drop("component")
    if heavy.head(1):
        heavy = heavy.join(labels, heavy.rep == labels.id, "left").withColumn("label", F.coalesce("component", "rep"))
        heavy = heavy.select("rep", "doc_id", "row", "weight", "label")
        more = _linked(_dealt_nodes(small.unionByName(large.select("node", "rep")), heavy), own, shingle, percent)
        labels = materialize(connected_components(links.unionByName(more)))
    named = sets.select("key", "rep", "doc_id").join(labels, sets.rep == labels.id, "left").select("key", "doc_id", F.coalesce("component", "rep").alias("label"))
    least = named.groupBy("label").agg(F.min("doc_id").alias("component"))
    found = sketched.select("doc_id", "row", "n_shingles", "key").join(named.select("key", "label").join(least, "label"), "key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    kept = F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")
    return found.select("doc_id", "n_shingles", component.alias("component_id"), kept, *(["row"] if rows else []))
