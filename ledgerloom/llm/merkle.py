"""A Merkle manifest of a table: a tree per group, a tree over the groups, and a proof for every row by octopus multiproofs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .tables import cut_lineage

#: Children of a node.
FAN = 16
#: Leaves of a task; the table is cut into as many contiguous parts as that takes.
PART_ROWS = 1 << 17
#: The tree over the groups' own roots, among the trees numbered from 0.
TOP = -1

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """A value for the digest of a leaf: its UTF-8 length, a colon, the value; ``-`` for null."""
    said = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said), F.lit("-"))


def height(n: int, fan: int = FAN) -> int:
    """Levels above ``n`` leaves until one node remains."""
    out = 0
    while n > 1:
        n, out = -(-n // fan), out + 1
    return out


def missing(first: int, stop: int, n: int, fan: int = FAN) -> Iterator[tuple[int, int]]:
    """Level and index of the nodes that leaves ``first:stop`` of ``n`` lack to derive the root: the octopus of the range.

    On each level those are the other members of the runs at both ends of the range's ancestors; whatever lies between, and
    every parent, follows from the leaves and from what was fetched below. At most ``2 * (fan - 1)`` a level.
    """
    level = 0
    while n > 1:
        left, right = first // fan * fan, min(n, -(-stop // fan) * fan)
        for i in (*range(left, first), *range(stop, right)):
            yield level, i
        first, stop, n, level = first // fan, -(-stop // fan), -(-n // fan), level + 1


def lifted(first: int, hashes: list[str], n: int, get: Callable[[int, int], str], fan: int = FAN) -> tuple[list[tuple[int, list[str]]], str]:
    """Levels from the leaves up, each as the index of its first node and the nodes of all runs that are touched; the root."""
    levels, level = [], 0
    while n > 1:
        stop = first + len(hashes)
        left, right = first // fan * fan, min(n, -(-stop // fan) * fan)
        row = [*(get(level, i) for i in range(left, first)), *hashes, *(get(level, i) for i in range(stop, right))]
        levels.append((left, row))
        hashes = [digest("".join(row[k: k + fan])) for k in range(0, len(row), fan)]
        first, n, level = left // fan, -(-n // fan), level + 1
    return levels, hashes[0]


def upper_proofs(levels: list[tuple[int, list[str]]], above: str, fan: int = FAN) -> list[str]:
    """Per run of the lowest level: the siblings on all levels above it, then ``above``."""
    proofs = [above]
    for (below, children), (left, row) in zip(reversed(levels[:-1]), reversed(levels[1:])):
        own = [siblings(row, k, fan) + proofs[k // fan] for k in range(len(row))]
        first = below // fan - left
        proofs = own[first: first + -(-len(children) // fan)]
    return proofs


def siblings(row: list[str], k: int, fan: int = FAN) -> str:
    """The others of node ``k``'s run, in a row that starts with a run."""
    start = k // fan * fan
    return "".join(row[start:k]) + "".join(row[k + 1: start + fan])


def fold(leaf: str, at: int, levels: list[tuple[int, list[str]]], fan: int = FAN) -> str:
    """The root over ``levels`` if leaf number ``at`` were ``leaf``."""
    for left, row in levels:
        k = at - left
        start = k // fan * fan
        leaf, at = digest("".join([*row[start:k], leaf, *row[k + 1: start + fan]])), at // fan
    return leaf


def _edges(fan: int):
    """The nodes of contiguous stretches of leaves whose parents need leaves from elsewhere, and roots of whole trees.

    No stretch spans two parts, so that each part finds its neighbours' nodes; one may be cut more finely.
    """

    def stretch(tree: int, first: int, hashes: list[str], n: int) -> Iterator[tuple]:
        level, top = 0, height(n, fan)
        while hashes:
            stop = first + len(hashes)
            if n == 1:
                yield tree, level, first, hashes[0], top
                return
            low, high = -(-first // fan), -(-stop // fan) if stop == n else stop // fan
            inside = range(low * fan, min(high * fan, stop)) if high > low else range(first, first)
            for i in (*range(first, min(stop, inside.start)), *range(max(first, inside.stop), stop)):
                yield tree, level, i, hashes[i - first], top
            hashes = [digest("".join(hashes[k - first: k - first + fan])) for k in range(inside.start, inside.stop, fan)]
            first, n, level = low, -(-n // fan), level + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = -1, None
        for batch in batches:
            if not batch.num_rows:
                continue
            part, tree, at, n = (batch.column(c).to_numpy() for c in ("part", "tree", "at", "n"))
            leaves = [d.hex() for d in batch.column("leaf").to_pylist()]
            cuts = np.flatnonzero((np.diff(part) != 0) | (np.diff(tree) != 0) | (np.diff(at) != 1)) + 1
            out = []
            for a, b in zip([0, *cuts], [*cuts, len(tree)]):
                if held and last == part[a] and held[0] == tree[a] and held[1] + len(held[2]) == at[a] and len(held[2]) < PART_ROWS:
                    held[2].extend(leaves[a:b])
                    continue
                if held:
                    out += stretch(*held)
                last, held = part[a], (int(tree[a]), int(at[a]), leaves[a:b], int(n[a]))
            if out:
                yield _nodes(out)
        if held:
            yield _nodes(list(stretch(*held)))

    return run


NODES = "tree bigint, level int, at bigint, hash string, height int"


def _nodes(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int32())
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["tree", "level", "at", "hash", "height"])


def _grown(nodes: DataFrame, levels: int, fan: int) -> DataFrame:
    """``nodes`` with all parents whose children are there, level by level. A group holds at most ``fan`` rows."""
    parts, below = [nodes], nodes.filter("level = 0")
    for level in range(levels):
        children = F.array_sort(F.collect_list(F.struct("at", "hash")))
        made = cut_lineage(below.filter(F.col("height") > level).groupBy("tree", F.expr(f"at div {fan}").alias("up"), "height").agg(
            F.sha2(F.array_join(F.transform(children, lambda c: c["hash"]), ""), 256).alias("hash")).select(
            "tree", F.lit(level + 1).alias("level"), F.col("up").alias("at"), "hash", "height"))
        parts.append(made)
        below = nodes.filter(F.col("level") == level + 1).unionByName(made)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _laid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the rows of a partition and its groups, which come one after the other."""
    part, rows, group, last = TaskContext.get().partitionId(), 0, -1, batches  # equal to no key
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column("key").to_pylist()
        number = np.empty(len(keys), np.int32)
        for i, key in enumerate(keys):
            if key != last:
                group, last = group + 1, key
            number[i] = group
        yield pa.record_batch({
            **{c: batch.column(c) for c in ("id", "key", "leaf", "tampered")}, "part": np.full(len(keys), part, np.int32),
            "place": rows + np.arange(len(keys), dtype=np.int64), "run": number,
        })
        rows += len(keys)


def _plan(runs: DataFrame) -> tuple[list[tuple], int, int]:
    """Per part: number of its first tree, leaves of that tree before the part, leaves of its first and its last tree.

    One row per part reaches the driver: only the first and the last group of a part can go on in others.
    """
    ends = runs.groupBy("part").agg(
        F.min_by(F.struct("key", "n"), "run").alias("first"), F.max_by(F.struct("key", "n"), "run").alias("last"), F.max("run").alias("runs"),
        F.max("n").alias("most"))
    parts = sorted(ends.collect(), key=lambda r: r.part)
    rows, trees, before, open_key = [], 0, 0, object()
    for r in parts:
        goes_on = r.first.key == open_key
        tree = trees - 1 if goes_on else trees
        rows.append([r.part, tree, before if goes_on else 0, 0, 0, tree + r.runs])
        trees = tree + r.runs + 1
        before = (before if goes_on and r.runs == 0 else 0) + r.last.n
        open_key = r.last.key
    totals: dict[int, int] = {}
    for r, row in zip(parts, rows):
        totals[row[1]] = totals.get(row[1], 0) + r.first.n
        if r.runs:
            totals[row[5]] = totals.get(row[5], 0) + r.last.n
    for row in rows:
        row[3], row[4] = totals[row[1]], totals[row[5]]
    return [tuple(r) for r in rows], trees, max([*totals.values(), *(r.most for r in parts)], default=0)


def _wanted(trees: int, fan: int):
    """What each part lacks: nodes of its first and last tree, and of the tree over all groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                ranges = {(r["tree"], r["before"], r["before"] + r["first_rows"], r["first_n"])}
                if r["last_tree"] != r["tree"]:
                    ranges.add((r["last_tree"], 0, r["last_rows"], r["last_n"]))
                ranges.add((TOP, r["tree"], r["last_tree"] + 1, trees))
                rows += [(r["part"], tree, level, i) for tree, a, b, n in ranges for level, i in missing(a, b, n, fan)]
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int32(), pa.int64()))], ["part", "tree", "level", "at"])

    return run


def _proved(trees: int, fan: int, id_kind: pa.DataType):
    """Expand the proofs of a part: fetched nodes first, then its leaves in order."""
    names = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def work(part: list[dict], known: dict[tuple[int, int, int], str]) -> Iterator[pa.RecordBatch]:
        cuts = [k for k in range(len(part)) if k == 0 or part[k]["tree"] != part[k - 1]["tree"]] + [len(part)]
        runs = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            tree, n = part[a]["tree"], part[a]["n"]
            runs.append((a, b, *lifted(part[a]["at"], [r["leaf"].hex() for r in part[a:b]], n, lambda level, i, tree=tree: known[tree, level, i], fan)))
        first = part[0]["tree"]
        top, root = lifted(first, [r[3] for r in runs], trees, lambda level, i: known[TOP, level, i], fan)
        above = upper_proofs(top, "", fan)
        for k, (a, b, levels, subroot) in enumerate(runs):
            over = ""
            if top:
                at = first + k - top[0][0]
                over = siblings(top[0][1], at, fan) + above[at // fan]
            upper = upper_proofs(levels, over, fan)
            out = []
            for r in part[a:b]:
                leaf, at = r["leaf"].hex(), r["at"]
                proof = over
                if levels:
                    place = at - levels[0][0]
                    proof = siblings(levels[0][1], place, fan) + upper[place // fan]
                folded = root  # the same leaf and siblings give the digests that are there already
                if r["tampered"] is not None and r["tampered"] != r["leaf"]:
                    folded = fold(fold(r["tampered"].hex(), at, levels, fan), first + k, top, fan)
                out.append((r["id"], leaf, subroot, root, digest(proof), folded, folded == root))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (id_kind, *[pa.string()] * 5, pa.bool_()))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, part, known = None, [], {}
        for batch in batches:
            for r in batch.to_pylist():
                if r["part"] != number:
                    if part:
                        yield from work(part, known)
                    number, part, known = r["part"], [], {}
                if r["hash"] is not None:
                    known[r["tree"], r["level"], r["at"]] = r["hash"]
                else:
                    part.append(r)
        if part:
            yield from work(part, known)

    return run


def manifest(
    docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), group_col: str = "source", id_col: str = "doc_id",
    fan: int = FAN, part_rows: int = PART_ROWS, tamper: Column | None = None, text_col: str = "text",
) -> DataFrame:
    """Root and proof of every row: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``.

    A leaf is the digest of a row's ``columns``. The leaves of a group ascend by id (then by digest); every ``fan`` nodes of
    a level become one, and a group's last node is its subroot. The subroots by group (null first, bytewise) likewise give
    the root. ``proof_sha256`` is the digest of all siblings from the leaf's own run up to the root. Where ``tamper`` holds,
    the row is read again with A to Z of ``text_col`` lowered, and ``folded_root`` is what that leaf and the original
    siblings give; elsewhere it is the root. ``verified`` says whether both agree.

    The rows are digested in place. Digests and ids are range-partitioned by group and id into parts of some
    ``part_rows``, so a group may span many parts. A stretch of leaves gives the nodes whose parents lie across its
    border, and those (some hundred a part) are joined to trees level by level, at most ``fan`` rows a group. Then each
    part computes the least set of nodes it lacks (:func:`missing`), fetches them in one join, derives all shared nodes and
    expands the proofs of its leaves by itself. The driver sees one row per part.

    Nulls of any column count as ``-``; a null id comes first and is never tampered with; repeated rows are leaves of
    their own, interchangeable among themselves. No rows give no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    leaf = F.sha2(F.concat(*(field(F.col(c)) for c in columns)), 256)
    changed = F.lit(None).cast("string")
    if tamper is not None:
        lowered = [field(F.translate(F.col(c), _UPPER, _LOWER) if c == text_col else F.col(c)) for c in columns]
        changed = F.when(tamper, F.sha2(F.concat(*lowered), 256))
    leaves = cut_lineage(docs.select(
        F.col(id_col).alias("id"), F.col(group_col).alias("key"), F.unhex(leaf).alias("leaf"), F.unhex(changed).alias("tampered"),
        F.monotonically_increasing_id().alias("copy")))
    kind = leaves.schema["id"].dataType
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-leaves.count() // part_rows))
    order = ["key", "id", "leaf", "copy"]
    laid = cut_lineage(leaves.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(
        _laid, f"id {kind.simpleString()}, key {leaves.schema['key'].dataType.simpleString()}, leaf binary, tampered binary, part int, place bigint, run int"))

    counted = cut_lineage(laid.groupBy("part", "run").agg(F.count("*").alias("n"), F.min("place").alias("start"), F.first("key").alias("key")))
    rows, trees, most = _plan(counted)
    parts = 1 + max((r[0] for r in rows), default=0)
    # one row per part, as many as tasks
    plan = F.broadcast(spark.createDataFrame(rows, "part int, tree bigint, before bigint, first_n bigint, last_n bigint, last_tree bigint"))
    runs = cut_lineage(counted.join(plan, "part").select(
        "part", "run", "start", F.col("n").alias("rows"), "before", "first_n", "last_n", "last_tree", F.col("tree").alias("first_tree"),
        (F.col("tree") + F.col("run")).alias("tree")))
    whole = F.when(F.col("run") == 0, F.col("first_n")).when(F.col("tree") == F.col("last_tree"), F.col("last_n")).otherwise(F.col("rows"))
    placed = runs.select("part", "run", "tree", whole.alias("n"), (F.when(F.col("run") == 0, F.col("before")).otherwise(0) - F.col("start")).alias("shift"))
    leaves_at = laid.join(placed, ["part", "run"]).select("part", "id", "tree", (F.col("place") + F.col("shift")).alias("at"), "n", "leaf", "tampered")

    edges = cut_lineage(leaves_at.sortWithinPartitions("part", "tree", "at").select("part", "tree", "at", "n", "leaf").mapInArrow(_edges(fan), NODES))
    inner = _grown(edges, height(most, fan), fan)
    subroots = cut_lineage(inner.filter("level = height").select(
        F.lit(TOP).cast("bigint").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("at"), "hash", F.lit(height(trees, fan)).alias("height")))
    nodes = inner.unionByName(_grown(subroots, height(trees, fan), fan))

    ends = runs.groupBy("part").agg(
        F.min("first_tree").alias("tree"), F.min("before").alias("before"), F.min("first_n").alias("first_n"), F.min("last_n").alias("last_n"),
        F.min("last_tree").alias("last_tree"), F.min_by("rows", "run").alias("first_rows"), F.max_by("rows", "run").alias("last_rows"))
    wanted = ends.mapInArrow(_wanted(trees, fan), "part int, tree bigint, level int, at bigint")
    fetched = wanted.join(nodes.select("tree", "level", "at", "hash"), ["tree", "level", "at"])
    none = F.lit(None)
    both = fetched.select("part", none.cast(kind).alias("id"), "tree", "level", "at", none.cast("bigint").alias("n"), none.cast("binary").alias("leaf"), none.cast("binary").alias("tampered"), "hash")
    both = both.unionByName(leaves_at.select("part", "id", "tree", none.cast("int").alias("level"), "at", "n", "leaf", "tampered", none.cast("string").alias("hash")))
    dealt = both.repartitionById(parts, "part").sortWithinPartitions("part", F.col("level").isNull(), "tree", "at")
    proved = dealt.mapInArrow(_proved(trees, fan, to_arrow_type(kind)), (
        f"id {kind.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"))
    return proved.withColumnRenamed("id", "doc_id")


def tampered_fifth(id_col: str = "doc_id") -> Column:
    """Whether 5 divides the checksum of the decimal id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
