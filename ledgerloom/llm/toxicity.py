"""Toxicity scores by weak supervision: mined voters, a generative label model, a linear classifier on its posteriors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytehash import LETTER_RUNS, LOWER_VALUES, mix, range_hashes, row_of, slices, text_bytes, word_ranges
from .tables import cut_lineage, held_out, text_of

#: Bytes of the word starts that serve as patterns; 0 stands for the whole word.
STEMS = (0, 4, 5, 6)
#: Unbroken runs of more bytes (scripts without spaces, codes) are looked at in pieces of two characters instead.
LONG = 48
#: Voters whose correlations are worked on at once, and weights that one Newton step changes: the driver holds a matrix of all
#: voters by the first, and a square one of the second.
VOTER_BLOCK, STEP_BLOCK = 1024, 4096
#: Pairs of voters whose common votes are kept between the rounds of the label model.
KEPT_PRODUCTS = 1 << 24
#: Training rows that models are fitted on; voters are mined from all of them.
FIT_ROWS = 20_000
#: Labels of up to so many rows (16 bytes each) are broadcast.
BROADCAST_ROWS = 2_000_000
#: Voters on the whole text, after the mined ones: any hit, two different hits, a hit per hundred words, no hit at all.
TEXT_VOTERS = 4


def _terms(column: pa.Array, stem: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word, or of its first ``stem`` bytes if it is longer; with row, place and the number of words."""
    data, limits = text_bytes(column)
    starts, ends = word_ranges(data, limits, LETTER_RUNS)
    over = ends - starts > LONG
    if over.any():
        pairs = _pairs(data, starts[over], ends[over])
        starts, ends = (np.concatenate([a[~over], b]) for a, b in zip((starts, ends), pairs))
        order = np.argsort(starts, kind="stable")
        starts, ends = starts[order], ends[order]
    first = row_of(starts, limits)
    rows = np.repeat(np.arange(len(column)), np.diff(first))
    if stem:
        long = ends - starts > stem
        starts, rows = starts[long], rows[long]
        ends = starts + stem
    return mix(_hashes(data, starts, ends) + np.uint64(stem)), rows, starts, ends, np.diff(first)


def _pairs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pieces of two neighbouring characters inside ranges: overlapping, never across a range."""
    size = ends - starts
    place = np.repeat(starts - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    of = np.repeat(np.arange(len(starts)), size)
    char = (data[place] & 0xC0) != 0x80
    place, of = place[char], of[char]
    stop = np.append(place[2:], 0)  # where the second next character starts
    same = np.zeros(len(place), bool)
    same[:-2] = of[2:] == of[:-2]
    two = np.zeros(len(place), bool)
    two[:-1] = of[1:] == of[:-1]
    stop = np.where(same, np.append(stop, np.zeros(max(0, len(place) - len(stop)), stop.dtype))[: len(place)], ends[of])
    return place[two], stop[two]


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ranges that may overlap their next one: every other one of them is disjoint."""
    out = np.empty(len(starts), np.uint64)
    apart = np.ones(len(starts), bool)
    apart[1:] = starts[1:] >= ends[:-1]
    if apart.all():
        return range_hashes(data, starts, ends, LOWER_VALUES)
    for odd in (0, 1):
        mine = np.arange(len(starts)) % 2 == odd
        out[mine] = range_hashes(data, starts[mine], ends[mine], LOWER_VALUES)
    return out


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch: in how many texts, and in how many toxic ones, each term stands; its bytes if some text is toxic."""
    for batch in slices(batches, 0):
        toxic = batch.column(1).to_numpy(zero_copy_only=False) > 0
        raw = text_bytes(batch.column(0))[0].tobytes().lower()
        for stem in STEMS:
            codes, rows, starts, ends, _ = _terms(batch.column(0), stem)
            order = np.lexsort((codes, rows))
            once = np.ones(len(codes), bool)
            once[1:] = (codes[order][1:] != codes[order][:-1]) | (rows[order][1:] != rows[order][:-1])
            at = order[once]
            keys, one, back, n = np.unique(codes[at], return_index=True, return_inverse=True, return_counts=True)
            hits = np.bincount(back, toxic[rows[at]], len(keys)).astype(np.int64)
            text = [raw[starts[i]: ends[i]] if h else None for i, h in zip(at[one], hits)]
            yield pa.record_batch([
                np.full(len(keys), stem, np.int32), keys.view(np.int64), n.astype(np.int64), hits, pa.array(text, pa.binary()),
            ], ["stem", "code", "n", "toxic", "term"])


@dataclass
class Voters:
    """Codes of the mined voters, by sort, and what they look for."""

    codes: dict[int, np.ndarray]
    terms: list[bytes]
    sorted: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)

    @property
    def count(self) -> int:
        return sum(map(len, self.codes.values())) + TEXT_VOTERS

    def votes(self, column: pa.Array) -> np.ndarray:
        """One row of 0/1 per text."""
        out, base, words = np.zeros((len(column), self.count), np.float32), 0, np.zeros(len(column))
        hits = np.zeros(len(column))
        for stem, known in self.codes.items():
            if len(known) or not stem:
                codes, rows, _, _, words = _terms(column, stem)
            if len(known):
                order, ranked = self._ranked(stem)
                at = np.searchsorted(ranked, codes)
                found = (at < len(known)) & (ranked[np.minimum(at, len(known) - 1)] == codes)
                out[rows[found], base + order[at[found]]] = 1
                hits = np.maximum(hits, np.bincount(rows[found], minlength=len(column)))
            base += len(known)
        out[:, base] = hits > 0
        out[:, base + 1] = hits > 1
        out[:, base + 2] = hits * 100 > np.maximum(words, 1)
        out[:, base + 3] = hits == 0
        return out


    def _ranked(self, stem: int) -> tuple[np.ndarray, np.ndarray]:
        if stem not in self.sorted:
            order = np.argsort(self.codes[stem])
            self.sorted[stem] = order, self.codes[stem][order]
        return self.sorted[stem]

    def parts(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The votes of some texts at a time: some million numbers, however many voters there are."""
        step = max(1, (1 << 23) // self.count)
        for a in range(0, len(column), step):
            yield self.votes(column.slice(a, step))


def mine(training: DataFrame, least: int = 3, precision: float = 0.7) -> Voters:
    """The words and word starts that stand in toxic training texts far more often than in others.

    A term needs ``least`` toxic texts, at least ``precision`` of its texts toxic, and a gain in log-likelihood that chance would
    not reach among all the terms that were counted. They all stand for election by gain; one of up to six bytes that starts
    another elected one, or that starts with an elected one of that length, says the same and is left out. A term has at most
    ``LONG`` bytes, so an elected one costs the driver some hundred bytes.
    """
    texts, bad = training.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    counts = cut_lineage(training.select("text", "y").mapInArrow(_count_terms, "stem int, code bigint, n bigint, toxic bigint, term binary").groupBy(
        "stem", "code").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"), F.max("term").alias("term")))
    chance = 0.6 * float(np.log(max(2, counts.count())))
    share = (F.col("toxic") + 0.1) / (F.col("n") + 0.2)
    prior = F.lit((bad + 0.1) / (texts + 0.2))
    gain = F.col("toxic") * F.log(share / prior) + (F.col("n") - F.col("toxic")) * F.log((1 - share) / (1 - prior))
    ranked = counts.filter((F.col("toxic") >= least) & (share >= precision) & (share > prior)).select(
        "stem", "code", "term", gain.alias("gain")).filter(F.col("gain") > chance)
    elected, terms, starts = [], set(), set()
    for r in sorted(ranked.collect(), key=lambda r: (-r.gain, STEMS.index(r.stem), r.code)):
        own = {bytes(r.term[:k]) for k in range(1, min(len(r.term), max(STEMS)) + 1)} | {bytes(r.term)}
        if bytes(r.term) not in starts and not own & terms:
            elected.append(r)
            terms.add(bytes(r.term))
            starts |= own
    elected.sort(key=lambda r: STEMS.index(r.stem))
    codes = {stem: np.array([r.code for r in elected if r.stem == stem], np.int64).view(np.uint64) for stem in STEMS}
    return Voters(codes, [bytes(r.term) for r in elected])


def blocks(votes: np.ndarray, rows: int = 1000) -> Iterator[tuple[slice, np.ndarray]]:
    """Some rows of 0/1 bytes at a time as numbers, so that memory does not grow with rows times voters in doubles."""
    for a in range(0, len(votes), rows):
        yield slice(a, a + rows), votes[a: a + rows].astype(float)


def weighted(votes: np.ndarray, *weights: np.ndarray) -> list[np.ndarray]:
    """For each weighting of the rows the sums of the columns."""
    return list(sum((np.array([w[at] for w in weights]) @ v for at, v in blocks(votes)), np.zeros((len(weights), votes.shape[1]))))


class LabelModel:
    """What voters do on toxic and on clean texts, estimated by expectation maximisation over the votes.

    The class of a text is hidden. What the training labels say about each voter enters as prior counts, ``strength`` of
    a text for each label, so that the hidden class keeps its meaning; accuracies then follow the votes. Voters that
    still agree once the class is known say the same thing twice: this correlation is estimated from the residuals, and
    a voter's weight is divided by its summed absolute correlations, its own included.
    """

    def __init__(self, votes: np.ndarray, y: np.ndarray, strength: float = 0.5, rounds: int = 30) -> None:
        q = y.astype(float)
        told = [(strength * k + 0.1, strength * w.sum() + 0.2) for w, k in zip((q, 1 - q), weighted(votes, q, 1 - q))]
        self.share, self.products = np.ones(votes.shape[1]), None
        for _ in range(rounds):
            self.prior = np.clip(q.mean(), 1e-3, 1 - 1e-3)
            self.on, self.off = ((h + k) / (w.sum() + n) for w, h, (k, n) in zip((q, 1 - q), weighted(votes, q, 1 - q), told))
            self.share = 1 / self._agreement(votes, q)
            new = self.posterior(votes)
            done = np.abs(new - q).max() < 1e-4
            q = new
            if done:
                break

    def _agreement(self, votes: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Per voter the sum of its correlations of 0.1 or more with all voters, itself included, a block of voters at a time.

        Products of residuals follow from those of the votes, which do not change from round to round: they are kept while
        they take up to ``KEPT_PRODUCTS`` numbers, and counted again for each block of more voters.
        """
        n, rest = votes.shape[1], 1 - q
        a, b = weighted(votes, q, rest)
        qq, qr, rr = q @ q, q @ rest, rest @ rest
        on, off = self.on, self.off
        squares = votes.sum(0, dtype=float) - 2 * (a * on + b * off) + qq * on**2 + 2 * qr * on * off + rr * off**2
        scale = np.sqrt(np.maximum(squares / len(votes), 1e-6))
        out = np.empty(n)
        for start in range(0, n, VOTER_BLOCK):
            mine = slice(start, min(n, start + VOTER_BLOCK))
            both = self._products(votes, mine).astype(float)
            left = np.column_stack([a, b, on, off])
            right = np.stack([on[mine], off[mine], qq * on[mine] + qr * off[mine] - a[mine], qr * on[mine] + rr * off[mine] - b[mine]])
            both += left * np.array([-1, -1, 1, 1]) @ right
            both = np.abs(both / len(votes) / scale[:, None] / scale[mine])
            both[np.arange(start, mine.stop), np.arange(mine.stop - start)] = 1
            out[mine] = np.where(both < 0.1, 0, both).sum(0)
        return out

    def _products(self, votes: np.ndarray, mine: slice) -> np.ndarray:
        """In how many texts each pair of voters votes; counts below 2**24 are exact in single precision."""
        n = votes.shape[1]
        if n * n > KEPT_PRODUCTS:
            return sum((v.astype(np.float32).T @ v[:, mine].astype(np.float32) for _, v in blocks(votes)), np.zeros((n, mine.stop - mine.start), np.float32))
        if self.products is None:
            self.products = np.zeros((n, n), np.float32)
            for _, v in blocks(votes):
                v = v.astype(np.float32)
                self.products += v.T @ v
        return self.products[:, mine]

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        on, off = np.log(self.on / self.off), np.log((1 - self.on) / (1 - self.off))
        z = np.log(self.prior / (1 - self.prior)) + off @ self.share + np.concatenate([v @ ((on - off) * self.share) for _, v in blocks(votes)])
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights of a logistic regression with soft labels; the last column of ``x`` is constant.

    Newton steps, on up to ``STEP_BLOCK`` weights at once; of more weights block after block, so that no matrix of all by all is held.
    """
    w = np.zeros(x.shape[1])
    w[-1] = np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))
    keep = np.append(np.full(len(w) - 1, ridge), 1e-6)
    parts = [np.arange(a, min(len(w), a + STEP_BLOCK)) for a in range(0, len(w), STEP_BLOCK)]
    for _ in range(rounds):
        moved = 0.0
        for part in parts:
            bend, slope = np.diag(keep[part]), -keep[part] * w[part]
            for at, v in blocks(x):
                p = 1 / (1 + np.exp(-np.clip(v @ w, -40, 40)))
                mine = v[:, part] if len(parts) > 1 else v
                slope += mine.T @ (y[at] - p)
                bend += (mine * (p * (1 - p) + 1e-9)[:, None]).T @ mine
            step = np.clip(np.linalg.solve(bend, slope), -4, 4)
            w[part] += step
            moved = max(moved, float(np.abs(step).max()))
        if moved < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, label: str, fit_rows: int, id_col: str, text_col: str) -> tuple[Voters, np.ndarray] | None:
    """Voters from all training rows; weights from the ``fit_rows`` labels with the smallest hashed ids.

    If ids repeat, the label model sees at most twice as many rows, those with the smallest hash of id and text.
    """
    known = labels.select(F.col("doc_id").alias("of"), F.col(label).cast("int").alias("y")).filter("y IS NOT NULL AND of IS NOT NULL").filter(~held_out("of"))
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))

    def of(side: DataFrame) -> DataFrame:
        return texts.join(side, F.col("id") == F.col("of")).select("id", "text", "y")

    voters = mine(of(F.broadcast(known) if known.count() <= BROADCAST_ROWS else known))
    training = of(F.broadcast(known.orderBy(F.xxhash64("of"), "of", "y").limit(fit_rows)))

    def cast(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            packed = [p.tobytes() for v in voters.parts(batch.column(0)) for p in np.packbits(v.astype(bool), axis=1)]
            yield pa.record_batch([pa.array(packed, pa.binary()), batch.column(1), batch.column(2)], ["votes", "y", "place"])

    cast_votes = training.select("text", "y", F.xxhash64("id", "text").alias("place")).mapInArrow(cast, "votes binary, y int, place bigint")
    rows = cast_votes.orderBy("place", "y", "votes").limit(2 * fit_rows).collect()  # bounded: a bit for each voter
    if not rows:
        return None
    votes = np.unpackbits(np.frombuffer(b"".join(r.votes for r in rows), np.uint8).reshape(len(rows), -1), axis=1)[:, : voters.count]
    model = LabelModel(votes, np.array([r.y for r in rows]) > 0)
    return voters, logistic(np.column_stack([votes, np.ones(len(votes), np.uint8)]), model.posterior(votes))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = 0.5, fit_rows: int = FIT_ROWS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score`` in 0..1 (higher: label 1 likelier), ``predicted``.

    Labels are read only from rows that are not held out: all of them mine the voters, whole words (the lexicon) and starts
    of words (the patterns), and at most ``fit_rows`` give the label model its votes and its prior. The classifier learns the
    model's posteriors, not the labels, and is applied to every whole text in one pass over the rows.

    Null and empty texts get the score of a text without hits; null labels and ids train nothing; repeated rows each get
    their score; without training rows every score is 0.0; no rows give no rows. Other columns are not read.
    """
    fitted = fit(docs, labels, label, fit_rows, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            score = np.zeros(batch.num_rows)
            if fitted:
                voters, w = fitted
                z = np.concatenate([v.astype(float) @ w[:-1] for v in voters.parts(batch.column(1))] or [np.zeros(0)]) + w[-1]
                score = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            yield pa.record_batch([batch.column(0), score], ["doc_id", "score"])

    out = rows.mapInArrow(scored, f"doc_id {kind}, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
