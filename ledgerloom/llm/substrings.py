"""Removal of repeated byte strings by bucket-pointer refinement of sampled suffixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytehash import CHUNK, Prefix, mix, slices, text_bytes
from .keyfilter import key_condition
from .tables import cut_lineage, text_of

U = np.uint64
_LOW = U((1 << 24) - 1)
NO_ID = -(1 << 63)
#: Rows between the steps: two bucket identifiers, the document, and ``start << 32 | version << 8 | windows``.
RUN = "a bigint, r bigint, doc bigint, pos bigint"
SPAN = "doc bigint, version int, start int, stop int, bucket bigint"
#: A run in question with its bytes.
HELD = "bucket bigint, doc bigint, pos bigint, bytes binary"


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours."""
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


class Texts:
    """The texts of a batch as bytes, with the place, id and version of each."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        self.doc = batch.column(0).to_numpy(zero_copy_only=False)
        self.version = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64) & _LOW
        self.data, self.limits = text_bytes(batch.column(2))

    def whole(self, width: int) -> np.ndarray:
        """Whether ``width`` bytes from each place on lie in one text."""
        edge = np.zeros(len(self.data) + 1, np.int8)
        np.add.at(edge, np.maximum(self.limits[1:] - width + 1, self.limits[:-1]), 1)
        np.add.at(edge, self.limits[1:], -1)
        return np.cumsum(edge[:-1], dtype=np.int8) == 0

    def rows(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.limits, place, "right") - 1


def _packed(texts: Texts, place: np.ndarray, windows: np.ndarray, a: np.ndarray, r: np.ndarray, width: int) -> pa.RecordBatch:
    """Rows for the shuffle. What a batch can settle itself leaves it as merged spans: ``windows`` 0, ``r`` the end."""
    row = texts.rows(place)
    doc, start = texts.doc[row], place - texts.limits[row]
    order = np.lexsort((start, doc, r, a))
    doc_o, start_o = doc[order], start[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (r[order][1:] != r[order][:-1])
    head = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    later = np.zeros(len(order), bool)
    later[order] = (doc_o != doc_o[head]) | (start_o != start_o[head])
    # spans of the settled ones, in the order of the batch: starts and ends both rise
    gone = np.flatnonzero(later)
    gone = gone[np.argsort(place[gone], kind="stable")]
    lo, hi = place[gone], place[gone] + windows[gone] + width - 1
    cut = np.ones(len(gone), bool)
    cut[1:] = (lo[1:] > hi[:-1]) | (row[gone][1:] != row[gone][:-1])
    last = np.append(cut[1:], True)[: len(gone)]
    span_row = row[gone][cut]
    span_lo, span_hi = lo[cut] - texts.limits[span_row], hi[last] - texts.limits[span_row]
    keep = ~later

    def pos(row: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
        return (start.astype(np.int64) << 32) | (texts.version[row].astype(np.int64) << 8) | n

    return pa.record_batch([
        np.concatenate([a[keep].view(np.int64), mix(texts.doc[span_row].view(U) + span_lo.astype(U)).view(np.int64)]),
        np.concatenate([r[keep].view(np.int64), span_hi.astype(np.int64)]),
        np.concatenate([doc[keep], texts.doc[span_row]]),
        np.concatenate([pos(row[keep], start[keep], windows[keep]), pos(span_row, span_lo, np.zeros(len(span_row), np.int64))]),
    ], ["a", "r", "doc", "pos"])


def _runs(length: int, depth: int):
    """Windows of ``length`` bytes, bucketed by one of their own grams of ``depth`` bytes.

    Of the grams in a window the one with the smallest hash is taken, the first of equals: windows with equal bytes take
    the same one, so only windows of one bucket can be equal. Neighbouring windows mostly share it and make a run.
    """
    grams = length - depth + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            texts = Texts(batch)
            fine = texts.whole(length)
            found = []
            for base in range(0, len(texts.data) - length + 1, CHUNK // 2):
                part = texts.data[base: base + CHUNK // 2 + length - 1]
                prefix = Prefix(part)
                hashes = prefix.every(depth)
                at = (_least((hashes & ~_LOW) | np.arange(len(hashes), dtype=U), grams) & _LOW).astype(np.int64)
                ok = fine[base: base + len(at)]
                change = np.ones(len(at), bool)
                change[1:] = (at[1:] != at[:-1]) | ~ok[:-1]
                first = np.flatnonzero(ok & change)
                stop = np.ones(len(at), bool)
                stop[:-1] = change[1:] | ~ok[1:]
                last = np.flatnonzero(ok & stop)
                found.append((base + first, last - first + 1, hashes[at[first]], prefix.of(first, last + length)))
            if found:
                place, windows, a, r = (np.concatenate(c) for c in zip(*found))
                if len(place):
                    yield _packed(texts, place, windows, a, r, length)

    return run


def _settled(length: int, group_by_bucket: bool):
    """Over rows sorted by (a, r, doc, pos): spans of what stands earlier too, and runs that stay in question.

    An equal run that is not the first is settled. A first run is in question if its bucket ``a`` has another one. The
    state is two rows, however large a bucket is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = None  # first row of the bucket, and first row of its last run if that is another

        def spans(doc, pos, stop, bucket=None) -> pa.RecordBatch:
            return pa.record_batch([
                doc, ((pos >> 8) & int(_LOW)).astype(np.int32), (pos >> 32).astype(np.int32), stop.astype(np.int32),
                np.zeros(len(doc), np.int64) if bucket is None else bucket], ["doc", "version", "start", "stop", "bucket"])

        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy() for i in range(4)]) if batch.num_rows else np.zeros((4, 0), np.int64)
            done = (rows[3] & 255) == 0
            if done.any():
                yield spans(rows[2][done], rows[3][done], rows[1][done])
            rows = rows[:, ~done]
            if not rows.shape[1]:
                continue
            old = 0 if carry is None else carry.shape[1]
            rows = rows if carry is None else np.concatenate([carry, rows], 1)
            a, r, doc, pos = rows
            n = len(a)
            new_a = np.ones(n, bool)
            new_a[1:] = a[1:] != a[:-1]
            new = new_a.copy()
            new[1:] |= r[1:] != r[:-1]
            head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            earlier = (doc != doc[head]) | ((pos >> 32) != (pos[head] >> 32))
            bucket = np.cumsum(new_a) - 1
            several = np.bincount(bucket, new)[bucket] > 1
            asked = ~earlier & (several | ~new) if group_by_bucket else np.zeros(n, bool)
            fresh = np.arange(n) >= old
            if old == 1:
                fresh[0] = True  # held back until now
                earlier[0] = False
            last_a = bucket == bucket[-1]
            starts = np.flatnonzero(last_a & new)
            if len(starts) == 1:
                asked[starts[0]] = False  # wait for another run of its bucket
            out = earlier & fresh
            if out.any():
                yield spans(doc[out], pos[out], (pos[out] >> 32) + (pos[out] & 255) + length - 1)
            out = asked & fresh
            if out.any():
                yield spans(doc[out], pos[out], -(pos[out] & 255), a[out])
            carry = rows[:, [starts[0]]] if len(starts) == 1 else rows[:, [starts[0], starts[-1]]]

    return run


def _questioned(length: int):
    """The runs in question of each text, with their bytes: a few per edit of a copied text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            texts = Texts(batch)
            lists = batch.column(3)
            row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            start, stop, bucket = (lists.flatten().field(i).to_numpy().astype(np.int64) for i in range(3))
            asked = stop < 0
            row, start, n, bucket = row[asked], start[asked], -stop[asked], bucket[asked]
            raw = texts.data.tobytes()
            place = texts.limits[row] + start
            held = [raw[a:b] for a, b in zip(place.tolist(), (place + n + length - 1).tolist())]
            pos = (start << 32) | (texts.version[row].astype(np.int64) << 8) | n
            yield pa.record_batch([bucket, texts.doc[row], pos, pa.array(held, pa.binary())], ["bucket", "doc", "pos", "bytes"])

    return run


def _windows(length: int, depth: int):
    """The windows of the runs in question, bucketed by what they hold at later offsets.

    Bucket identifiers start as hashes of ``depth`` bytes. Each round refines a bucket by the identifier at the offset it
    already covers, so the identifiers found in one round are the pointers of the next and the depth doubles; the last
    two identifiers, half a window apart, are the bucket and its refinement. Equal windows come from one bucket and so
    are in one partition already: sorting them needs no further shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 3):
            data, limits = text_bytes(batch.column(3))
            doc, pos = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            at = 0
            while at < len(doc):
                to = max(at + 1, int(np.searchsorted(limits, limits[at] + CHUNK, "right")) - 1)
                n = pos[at:to] & 255
                row = np.repeat(np.arange(at, to), n)
                step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                pointer, reach = Prefix(data[limits[at]: limits[to]]).every(depth), depth
                while 2 * reach < length:
                    pointer = mix(pointer[:-reach] * U(0xD6E8FEB86659FD93) + pointer[reach:])
                    reach *= 2
                place = limits[row] - limits[at] + step
                yield pa.record_batch([
                    pointer[place].view(np.int64), pointer[place + length - reach].view(np.int64), doc[row],
                    (((pos[row] >> 32) + step) << 32) | (pos[row] & (int(_LOW) << 8)) | 1], ["a", "r", "doc", "pos"])
                at = to

    return run


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the spans out of each text."""
    for batch in slices(batches, 2):
        data, limits = text_bytes(batch.column(2))
        names = ["n_bytes", "n_removed", "n_spans"]
        numbers, digests, texts = {c: [] for c in names}, [], []
        for i, spans in enumerate(batch.column(3)):
            own = data[limits[i]: limits[i + 1]]
            cut = []
            if spans.is_valid and len(spans.values):
                lo, hi = (spans.values.field(j).to_numpy() for j in (0, 1))
                lo, hi = lo[hi > 0], hi[hi > 0]
                order = np.argsort(lo, kind="stable")
                for a, b in zip(lo[order].tolist(), hi[order].tolist()):
                    if cut and a <= cut[-1][1]:
                        cut[-1][1] = max(cut[-1][1], b)
                    else:
                        cut.append([a, b])
            ends = [0, *(x for pair in cut for x in pair), len(own)]
            left = b"".join(own[a:b].tobytes() for a, b in zip(ends[::2], ends[1::2]))
            for c, v in zip(names, (len(own), len(own) - len(left), len(cut))):
                numbers[c].append(v)
            digests.append(hashlib.sha256(left).hexdigest())
            texts.append(left)
        yield pa.record_batch([batch.column(0), batch.column(1), *(pa.array(numbers[c], pa.int64()) for c in names), pa.array(digests, pa.string()), pa.array(
            texts, pa.binary())], ["doc", "version", *names, "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, length: int = 100, depth: int = 25, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Cut every byte that is covered by a ``length``-byte string which also starts earlier, in id order, in the input.

    One row per row of ``docs``: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal runs cut), ``kept_sha256``,
    ``kept`` (the bytes left). Texts are UTF-8 bytes; matches never cross documents.

    Windows of ``length`` bytes fall into buckets by a gram of ``depth`` bytes (see ``_runs``), one row per run of windows.
    Equal runs settle whole stretches at once. Buckets with different runs are gathered with their bytes and refined window
    by window by the bucket identifiers at later offsets (see ``_windows``). ``length`` must be ``depth`` doubled some times. Identifiers are
    64-bit hashes, two per comparison. Every task first settles repeats within its own batch, so a string that
    many documents hold reaches the shuffle once per batch; the sorted rows are then read with two rows of state.

    Null and empty texts are empty and keep nothing; texts shorter than ``length`` stay whole; texts of any length are read
    in chunks. Rows with equal ids are one place in the order: none of them is earlier than another, repeated rows get
    equal results. A null id comes before all others. No rows give no rows. Other columns are not read.
    """
    text = text_of(text_col)
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    rows = docs.select(doc.alias("doc"), F.xxhash64(text).alias("key"), text.alias("text"))
    sort = ("a", "r", "doc", "pos")
    runs = rows.mapInArrow(_runs(length, depth), RUN).repartition("a").sortWithinPartitions(*sort)
    settled = runs.mapInArrow(_settled(length, True), SPAN)
    first = cut_lineage(settled.groupBy("doc", "version").agg(F.collect_list(F.struct("start", "stop", "bucket")).alias("spans")))

    version = F.col("key").bitwiseAND(int(_LOW)).cast("int")
    tag: Column = F.xxhash64("doc", "version")
    named = rows.select("doc", version.alias("version"), "key", "text")

    def chosen(keys: DataFrame, wanted: bool) -> DataFrame:
        maybe = key_condition(keys.select(tag))(tag)
        return named.filter(maybe if wanted else ~maybe)

    open_docs = first.filter(F.exists("spans", lambda s: s["stop"] < 0))
    held = chosen(open_docs, True).join(open_docs, ["doc", "version"]).select("doc", "key", "text", "spans")
    windows = held.mapInArrow(_questioned(length), HELD).repartition("bucket").mapInArrow(_windows(length, depth), RUN)
    second = windows.sortWithinPartitions(*sort).mapInArrow(_settled(length, False), SPAN).groupBy("doc", "version").agg(
        F.collect_list(F.struct("start", "stop")).alias("spans"))
    closed = first.select("doc", "version", F.transform(F.filter("spans", lambda s: s["stop"] > 0), lambda s: F.struct(
        s["start"].alias("start"), s["stop"].alias("stop"))).alias("spans")).filter("size(spans) > 0")
    spans = cut_lineage(closed.unionByName(second).groupBy("doc", "version").agg(F.flatten(F.collect_list("spans")).alias("spans")))

    # texts without spans never leave the JVM
    own, none = F.col("text").cast("binary"), F.lit(0).cast("long")
    whole = chosen(spans, False).select("doc", "version", F.octet_length("text").cast("long").alias("n_bytes"), none.alias("n_removed"), none.alias(
        "n_spans"), F.sha2(own, 256).alias("kept_sha256"), own.alias("kept"))
    cut = chosen(spans, True).join(spans, ["doc", "version"], "left").select("doc", "version", "text", "spans")
    out = whole.unionByName(cut.mapInArrow(
        _kept, "doc bigint, version int, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"))
    return out.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
