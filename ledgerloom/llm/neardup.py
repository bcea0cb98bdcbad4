"""Near-duplicate groups: HyperMinHash bands propose, full shingle sets confirm, links join into components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytehash import mix, slices
from .graph import rooted
from .keyfilter import key_filter
from .minhash import Sketcher, shingle_sets
from .tables import cut_lineage, text_of

#: Members of a bucket that are compared with as many others in one step; larger buckets are split into such blocks.
BLOCK = 256


def _sketched(docs: DataFrame, shingle: int, sketcher: Sketcher) -> DataFrame:
    """Per row: ``doc_id``, ``text_key``, ``n`` (set size), ``cid`` and ``cid2`` (hashes of the set), registers, counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            sets = shingle_sets(batch.column(2), shingle)
            one = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64)
            two = np.array([mix(s ^ np.uint64(0x2545F4914F6CDD1D)).sum(dtype=np.uint64) for s in sets], np.uint64)
            sketches = [sketcher.of(s) if len(s) else None for s in sets]
            yield pa.record_batch([
                batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), mix(one).view(np.int64), two.view(np.int64),
                pa.array([s and s[0].tobytes() for s in sketches], pa.binary()), pa.array([s and s[1].tobytes() for s in sketches], pa.binary()),
            ], ["doc_id", "text_key", "n", "cid", "cid2", "registers", "counts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, text_key bigint, n bigint, cid bigint, cid2 bigint, registers binary, counts binary")


def _bands(classes: DataFrame, sketcher: Sketcher) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                held = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                keys = sketcher.band_keys(held).view(np.int64)
                cid = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), sketcher.bands)
                yield pa.record_batch([keys.ravel(), cid], ["key", "cid"])

    return classes.select("cid", "registers").mapInArrow(run, "key bigint, cid bigint")


def _blocks(rows: DataFrame) -> DataFrame:
    """Deal the members of each bucket into blocks, and give every pair of blocks a group of its own.

    ``rows`` has ``size``, the members of the bucket. A member takes part in as many groups as its bucket has blocks.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("cid"), blocks).cast("int")
    spread = rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return spread.withColumn("group", F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other"))).drop("size")


def _compared(rows: DataFrame, sketcher: Sketcher, limit: float) -> DataFrame:
    """Pairs (a, b) of the groups whose components differ and whose sketches allow a link."""
    width = sketcher.size

    def pairs_of(part: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        n = len(part["cid"])
        found = []
        for i in range(n - 1):
            rest = np.arange(i + 1, n)
            # blocks of one bucket meet their own members only in the group of that block with itself
            cross = (part["mine"][i] != part["mine"][rest]) | (part["mine"][i] == part["other"][rest])
            rest = rest[cross & (part["root"][rest] != part["root"][i])]
            if len(rest):
                ok = sketcher.possible(part["registers"][i], part["registers"][rest], part["counts"][i], part["counts"][rest], part["n"][i], part["n"][rest], limit)
                found += [(i, j) for j in rest[ok]]
        at = np.array(found, np.int64).reshape(-1, 2)
        x, y = part["cid"][at[:, 0]], part["cid"][at[:, 1]]
        return np.minimum(x, y), np.maximum(x, y)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the last group, not yet known to be whole

        def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
            group = table.column("group").to_numpy()
            cuts = np.flatnonzero(np.diff(group)) + 1
            columns = {c: table.column(c).to_numpy() for c in ("cid", "n", "root", "mine", "other")}
            for c in ("registers", "counts"):
                columns[c] = np.frombuffer(b"".join(table.column(c).to_pylist()), np.uint8).reshape(-1, width)
            for a, b in zip([0, *cuts], [*cuts, len(group)]):
                x, y = pairs_of({c: v[a:b] for c, v in columns.items()})
                if len(x):
                    yield pa.record_batch([x, y], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            group = batch.column("group").to_numpy()
            last = int(np.searchsorted(group, group[-1], "left"))  # sorted within the partition
            if last or (held and held[-1].column("group")[0].as_py() != group[0]):
                yield from work(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held = [batch.slice(last)]
            else:
                held.append(batch)
        if held:
            yield from work(pa.Table.from_batches(held))

    return rows.repartition("group").sortWithinPartitions("group").select(
        "group", "cid", "n", "root", "mine", "other", "registers", "counts").mapInArrow(run, "a bigint, b bigint").distinct()


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets have 100 * intersection >= percent * union."""
    reps = classes.select("cid", F.col("rep.doc_id").alias("doc_id"), F.col("rep.text_key").alias("text_key"))
    wanted = cut_lineage(pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct().join(reps, "cid"))
    maybe = key_filter(wanted.select("text_key"))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(maybe(batch.column(1))))

    kind = docs.schema["doc_id"].dataType.simpleString()
    near = docs.mapInArrow(some, f"doc_id {kind}, text_key bigint, text string")
    held = near.join(wanted.withColumnsRenamed({"doc_id": "of", "text_key": "of_key"}), F.col("doc_id").eqNullSafe(F.col("of")) & (
        F.col("text_key") == F.col("of_key")))
    texts = cut_lineage(held.groupBy("cid").agg(F.min("text").alias("text")))  # repeated rows hold the same text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(slices(batches, 2), 3):
            ok = []
            for x, y in zip(shingle_sets(batch.column(2), shingle), shingle_sets(batch.column(3), shingle)):
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    left, right = (texts.select(F.col("cid").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = 42, rows: int = 6, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Group documents whose sets of word shingles are similar: 100 * intersection >= ``percent`` * union.

    One row per row of ``docs``: ``doc_id``, ``text_key`` (hash of the text), ``n_shingles``, ``component_id`` (the
    smallest id reachable over links), ``kept`` (whether that is its own id).

    Equal sets are one class. Classes with an equal band of registers share a bucket. First each bucket's most central
    member (the one with most company over all its buckets) is compared with all others there, on full sets. Buckets
    that still hold several components are then searched whole, in blocks and by sketch alone; the pairs the sketches
    cannot rule out are confirmed on full sets. With 42 bands of 6 registers a pair at 0.85 is missed by all bands with a
    chance of about two in a billion, one at 0.8 with 2.8 in a million, (1 - 0.8**6)**42, or a little less
    where registers match by chance. Missed pairs are not searched in another way.

    Null and empty texts have no shingles and are linked with nothing. Texts are read whole. Rows with equal ids and texts
    are one document twice and get equal results; a null id ranks last, so it names a group only where all ids are null.
    No rows give no rows. Other columns are not read. The second step costs sketch comparisons quadratic in the size of a
    bucket of near copies that are not linked to each other.
    """
    limit = percent / 100
    sketcher = Sketcher(bands, rows)
    text = text_of(text_col)
    rows_in = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    sketched = cut_lineage(_sketched(rows_in, shingle, sketcher))
    first: Column = F.min_by(F.struct("doc_id", "text_key", "registers", "counts"), F.struct(F.col("doc_id").isNull(), "doc_id", "text_key"))
    classes = cut_lineage(sketched.filter("n > 0").groupBy("cid", "cid2", "n").agg(first.alias("rep")).select(
        "cid", "n", F.struct("rep.doc_id", "rep.text_key").alias("rep"), "rep.registers", "rep.counts"))

    keyed = _bands(classes, sketcher)
    shared = keyed.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    buckets = cut_lineage(keyed.join(shared, "key"))
    company = buckets.groupBy("cid").agg(F.sum("size").alias("company"))
    known = buckets.join(company, "cid")
    centre = known.groupBy("key").agg(F.max(F.struct("company", "cid"))["cid"].alias("centre"))
    stars = cut_lineage(known.join(centre, "key").filter("cid != centre").select(
        F.least("cid", "centre").alias("a"), F.greatest("cid", "centre").alias("b")).distinct())
    links = cut_lineage(_confirmed(stars, classes, rows_in, shingle, percent))

    roots = rooted(links).toDF("cid", "root")
    placed = buckets.join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    mixed = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi").select("key")
    open_rows = placed.join(mixed, "key").join(classes.select("cid", "n", "registers", "counts"), "cid")
    rest = cut_lineage(_compared(_blocks(open_rows), sketcher, limit).join(stars, ["a", "b"], "left_anti"))
    # the components found so far stand for their links
    links = roots.toDF("a", "b").unionByName(cut_lineage(_confirmed(rest, classes, rows_in, shingle, percent)))

    roots = rooted(links).toDF("cid", "root")
    named = classes.select("cid", F.col("rep.doc_id").alias("doc_id")).join(roots, "cid", "left").select(
        "cid", "doc_id", F.coalesce("root", "cid").alias("root"))
    # stored, so that the join back on the root of a very large group is a plain one, which adaptive execution splits
    smallest = cut_lineage(named.groupBy("root").agg(F.min("doc_id").alias("component_id")))
    owner = named.join(smallest, "root").select("cid", "component_id")
    group = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return sketched.select("doc_id", "text_key", "n", F.when(F.col("n") > 0, F.col("cid")).alias("cid")).join(owner, "cid", "left").select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"), group.alias("component_id"), F.col("doc_id").eqNullSafe(group).alias("kept"))


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, that keep one document of each near-duplicate group: the smallest id.

    A row that repeats both id and text of another is dropped too. Null ids count as one id.
    """
    found = near_duplicates(docs, shingle, percent, id_col=id_col, text_col=text_col, **options)
    stay = found.filter("kept").select(F.col("doc_id").alias("__of"), F.col("text_key").alias("__key")).distinct()
    keyed = docs.withColumn("__text_key", F.xxhash64(text_of(text_col)))
    one = keyed.join(stay, F.col(id_col).eqNullSafe(F.col("__of")) & (F.col("__text_key") == F.col("__key")), "left_semi")
    return one.dropDuplicates([id_col, "__text_key"]).drop("__text_key")
