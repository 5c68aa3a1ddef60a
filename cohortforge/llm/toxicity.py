"""Toxicity by weak supervision.

1. Words, and beginnings of the other words (``KINDS``), that stand out in the
   labelled sample form a lexicon; each task counts them in a fixed array of
   ``SLOTS`` slots.  Of near copies (texts that share one of ``SIGNATURES``
   minima of word pair hashes) only one counts as evidence.
2. Each lexicon voter holds entries of one kind (whole words, beginnings), one
   band of how much likelier they are in toxic texts (``BANDS``) and one of how
   many texts have them (``RARITY``); further voters look at patterns (how many
   hits, how dense, shouting, none at all).  A voter says toxic, clean or nothing.
3. A generative label model sees the votes alone, not the sample's labels: it
   estimates by expectation maximisation how often each voter votes how in either
   class, from a start at the balance of votes.  What voters still have in common
   within a class is their correlation; correlated voters share their weight, and
   the estimates are made anew.
4. A logistic regression on hit lexicon entries and patterns is trained on the
   posterior labels; its outputs are calibrated to the sample's own labels by one
   scale and one shift, and it scores every text.

Training takes a bounded sample (``samples.MAX_TRAINING_ROWS``) outside fold 0;
its class share is the prior.  Null and empty texts have no hits.  Without
labelled rows of both kinds every score is the share of toxic ones (0 if there
are no rows).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortforge.llm import bytesops as B
from cohortforge.llm.samples import MAX_TRAINING_ROWS, fold, labelled
from cohortforge.llm.shared import partitions, table

SLOTS = 1 << 20
PARTS = 64
#: Whole words, and the first bytes of longer words.
KINDS = (0, 4, 5, 6)
SIGNATURES = 4
#: An entry must be far likelier in toxic texts, by more than chance makes of some hundred thousand candidates.
LEAST_EVIDENCE, LEAST_ODDS, MOST_ENTRIES = 12.0, 2.5, 4096
#: Log odds and numbers of texts at which the next band of lexicon voters begins.
BANDS, RARITY = (3.5, 4.5, 5.5), (20, 100)
GROUPS = 2 * (len(BANDS) + 1) * (len(RARITY) + 1)
PATTERNS = ["hits>=1", "hits>=2", "hits>=3", "hits>=5", "distinct>=2", "distinct>=3", "density", "none", "shouting", "exclaiming"]


def slots_of(buf: np.ndarray, off: np.ndarray, words: np.ndarray | None, *, whole: bool = True, begun: bool = True):
    """Slots, rows and word numbers of words and of the beginnings of words not in the table ``words``; each word's own slot."""
    text = B.translated(buf, B.NON_WORD)
    starts, ends, rows = B.word_spans(text, off)
    hasher = B.Hasher(text)
    own = (B.mix(hasher.spans(starts, ends)) >> np.uint64(44)).astype(np.int64)
    slots, of = ([own], [np.arange(len(own))]) if whole else ([], [])
    if begun:
        other = np.ones(len(own), bool) if words is None else words[own] < 0
        for kind in KINDS[1:]:
            keep = np.flatnonzero(other & (ends - starts > kind))
            a = starts[keep]
            slots.append((B.mix(hasher.spans(a, a + kind) + np.uint64(kind)) >> np.uint64(44)).astype(np.int64))
            of.append(keep)
    word = np.concatenate(of)
    return np.concatenate(slots), rows[word], word, own


def _count_slots(words: np.ndarray | None):
    def run(batches):
        held = np.zeros((2, SLOTS), "<i4")
        some = False
        for batch in batches:
            buf, off = B.utf8(batch.column(0))
            y = batch.column(1).to_numpy(zero_copy_only=False) > 0
            for a, b in B.chunks(off):
                slots, rows, *_ = slots_of(buf[off[a] : off[b]], off[a : b + 1] - off[a], words, whole=words is None, begun=words is not None)
                pairs = np.unique(rows * SLOTS + slots)
                toxic = y[a:b][pairs // SLOTS]
                held[1] += np.bincount(pairs[toxic] % SLOTS, minlength=SLOTS).astype("<i4")
                held[0] += np.bincount(pairs[~toxic] % SLOTS, minlength=SLOTS).astype("<i4")
                some = True
        if some:
            wide = SLOTS // PARTS
            yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([held[:, i * wide : (i + 1) * wide].tobytes() for i in range(PARTS)], pa.binary())], names=["part", "counts"])

    return run


def _signatures(batches):
    """Minima of word pair hashes under SIGNATURES orders; an own value for texts without pairs."""
    for batch in batches:
        buf, off = B.utf8(batch.column(0))
        for a, b in B.chunks(off):
            text, at = B.translated(buf[off[a] : off[b]], B.NON_WORD), off[a : b + 1] - off[a]
            starts, ends, rows = B.word_spans(text, at)
            words = B.Hasher(text).spans(starts, ends)
            pair = B.mix(words[1:] * np.uint64(3) + words[:-1])
            own = np.flatnonzero(rows[1:] == rows[:-1])
            cols = []
            for k in range(SIGNATURES):
                least = np.full(b - a, 2**63 - 1, np.int64)
                np.minimum.at(least, rows[1:][own], (B.mix(pair[own] + np.uint64(k)) >> np.uint64(1)).astype(np.int64))
                cols.append(least)
            yield pa.RecordBatch.from_arrays([batch.column(2).slice(a, b - a), *map(pa.array, cols)], names=["doc_id", *(f"s{k}" for k in range(SIGNATURES))])


def without_copies(sample: DataFrame) -> DataFrame:
    """One of each group of near copies in the (bounded) sample."""
    kind = dict(sample.dtypes)["doc_id"]
    ids = sample.mapInArrow(_signatures, f"doc_id {kind}, " + ", ".join(f"s{k} long" for k in range(SIGNATURES))).distinct()
    alone = ids.where(F.col("s0") == 2**63 - 1)  # texts without pairs: no window gathers them
    ids = ids.where(F.col("s0") != 2**63 - 1)
    for k in range(SIGNATURES):
        first = F.row_number().over(Window.partitionBy(f"s{k}").orderBy("doc_id"))
        ids = ids.withColumn("_n", first).where(F.col("_n") == 1).drop("_n")
    ids = ids.unionByName(alone)
    return sample.join(F.broadcast(ids.select("doc_id").distinct()), "doc_id", "left_semi").select("text", "y")


def evidence(neg: np.ndarray, pos: np.ndarray, share: float) -> np.ndarray:
    """Log likelihood ratio of an entry's own share of toxic texts against the overall one."""
    n = np.maximum(pos + neg, 1)
    p = np.clip(pos / n, 1e-12, 1 - 1e-12)
    return n * (p * np.log(p / share) + (1 - p) * np.log((1 - p) / (1 - share)))


def _select_slots(clean: int, toxic: int):
    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = np.frombuffer(raw, "<i4").reshape(2, -1).astype(np.int64)
                held[part] = held.get(part, 0) + counts
        for part, (neg, pos) in sorted(held.items()):
            odds = np.log((pos + 0.5) / (toxic + 1)) - np.log((neg + 0.5) / (clean + 1))
            gain = evidence(neg, pos, toxic / (clean + toxic))
            at = np.flatnonzero((gain >= LEAST_EVIDENCE) & (odds >= LEAST_ODDS))
            yield pa.RecordBatch.from_arrays([pa.array(at + part * (SLOTS // PARTS)), pa.array(gain[at]), pa.array(odds[at]), pa.array((neg + pos)[at])], names=["slot", "gain", "odds", "texts"])

    return run


def lexicon(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The slots of the lexicon (words, best first, then beginnings of other words) and each one's voter."""
    single = without_copies(sample).persist()
    counts = {r.y: r["count"] for r in single.groupBy("y").count().collect()}
    clean, toxic = counts.get(0, 0), counts.get(1, 0)
    slots, voters = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for words in (False, True):
        known = None
        if words:
            known = np.full(SLOTS, -1, np.int16)
            known[slots] = 0
        counts = single.mapInArrow(_count_slots(known), "part int, counts binary").repartition(min(PARTS, partitions(sample.sparkSession)), "part")
        chosen = counts.mapInArrow(_select_slots(clean, toxic), "slot long, gain double, odds double, texts long")
        best = [r for r in chosen.orderBy(F.desc("gain"), "slot").limit(MOST_ENTRIES).collect() if r.slot not in set(slots.tolist())]
        band, rarity = np.searchsorted(BANDS, [r.odds for r in best]), np.searchsorted(RARITY, [r.texts for r in best])
        slots = np.concatenate([slots, np.array([r.slot for r in best], np.int64)])
        voters = np.concatenate([voters, (words * (len(BANDS) + 1) + band) * (len(RARITY) + 1) + rarity])
    single.unpersist()
    return slots, voters


# --- voters --------------------------------------------------------------------------------------


class Voters:
    def __init__(self, slots: np.ndarray, voters: np.ndarray):
        self.slots, self.voters = slots, voters
        self.entry = np.full(SLOTS, -1, np.int32)
        self.entry[slots] = np.arange(len(slots))

    def hits(self, buf: np.ndarray, off: np.ndarray):
        """Rows and entries of all hits (repeated ones too), and the pattern columns of each text."""
        n = len(off) - 1
        slots, rows, word, own = slots_of(buf, off, self.entry)
        entry = self.entry[slots]
        found = np.flatnonzero(entry >= 0)
        m = max(len(self.slots), 1)
        pairs = np.unique(rows[found] * np.int64(m) + entry[found])
        words, at = np.unique(word[found], return_index=True)
        word_rows = rows[found][at]
        hits = np.bincount(word_rows, minlength=n)
        distinct = np.bincount(np.unique(word_rows * np.int64(SLOTS) + own[words]) // SLOTS, minlength=n)
        size = np.maximum(np.diff(off), 1)
        total = np.zeros((2, len(buf) + 1), np.int64)
        np.cumsum((buf >= 65) & (buf <= 90), out=total[0, 1:])
        np.cumsum(buf == 33, out=total[1, 1:])
        upper, marks = total[:, off[1:]] - total[:, off[:-1]]
        density = hits * 100 / size
        patterns = np.stack([hits >= 1, hits >= 2, hits >= 3, hits >= 5, distinct >= 2, distinct >= 3, density >= 0.2, hits == 0, upper * 2 > size, marks * 20 > size], axis=1)
        return pairs // m, pairs % m, patterns

    def votes(self, rows, entries, patterns) -> np.ndarray:
        """1 toxic, 0 nothing, -1 clean; lexicon voters first, then the patterns."""
        n = len(patterns)
        lexical = np.zeros((n, GROUPS), np.int8)
        lexical[rows, self.voters[entries]] = 1
        toxic = patterns.astype(np.int8)
        toxic[:, 1:6] = np.where(patterns[:, 1:6], 1, -1)
        toxic[:, 0] = 0  # one word alone says nothing
        toxic[:, 7] = -toxic[:, 7]
        return np.concatenate([lexical, toxic], axis=1)


class LabelModel:
    """Vote frequencies in each class, correlations, and posterior labels."""

    def __init__(self, votes: np.ndarray, prior: float, steps: int = 30, rounds: int = 3):
        self.prior, self.weight = prior, np.ones(votes.shape[1])
        seen, back, count = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
        hot = np.stack([seen == v for v in (-1, 0, 1)], axis=2).astype(float)
        # toxic votes are rare and clean ones common: the start is the share of texts with a smaller balance, against the prior
        balance = seen.sum(axis=1, dtype=np.int64)
        order = np.argsort(balance, kind="stable")
        below = np.empty(len(seen))
        below[order] = np.cumsum(count[order]) - count[order] / 2
        post = 1 / (1 + np.exp(-np.clip(20 * (below / max(count.sum(), 1) - (1 - prior)), -60, 60)))
        for _ in range(rounds):
            for _ in range(steps):
                mass = np.stack([count * (1 - post), count * post])
                rate = np.einsum("cn,nvk->cvk", mass, hot) + 1.0
                self.rate = rate / rate.sum(axis=2, keepdims=True)
                new = self._posterior(hot)
                if np.abs(new - post).max(initial=0) < 1e-6:
                    break
                post = new
            self.correlation = self._left(seen, count, post)
            shared = np.where(np.abs(self.correlation) > 0.2, np.abs(self.correlation), 0)
            self.weight = 1 / np.maximum(shared.sum(axis=1), 1)
            post = self._posterior(hot)
        self.labels = post[back.ravel()] if len(seen) else post

    def _posterior(self, hot):
        logs = np.einsum("nvk,cvk,v->cn", hot, np.log(self.rate), self.weight)
        z = logs[1] - logs[0] + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))

    def _left(self, seen, count, post):
        """Correlation of what the votes are beyond their class means."""
        means = self.rate[:, :, 2] - self.rate[:, :, 0]
        rest = np.concatenate([seen - means[0], seen - means[1]])
        w = np.concatenate([count * (1 - post), count * post])
        cov = np.einsum("n,nv,nu->vu", w, rest, rest) / max(w.sum(), 1)
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        return cov / sd[:, None] / sd[None, :]


class Linear:
    """Logistic regression over hit entries and patterns."""

    def __init__(self, n_entries: int, rows, entries, patterns, target, steps: int = 400, l2: float = 1e-4):
        n, m = len(target), max(len(target), 1)
        self.w, self.v, self.b = np.zeros(max(n_entries, 1)), np.zeros(patterns.shape[1]), 0.0
        squares = [np.zeros_like(self.w), np.zeros_like(self.v), 0.0]
        x = patterns.astype(float)
        for _ in range(steps):
            z = self.b + x @ self.v + np.bincount(rows, self.w[entries], n)
            left = target - 1 / (1 + np.exp(-z))
            slopes = [np.bincount(entries, left[rows], len(self.w)) / m - l2 * self.w, x.T @ left / m - l2 * self.v, left.sum() / m]
            squares = [s + g**2 for s, g in zip(squares, slopes)]
            self.w, self.v, self.b = (p + 0.5 * g / np.sqrt(s + 1e-12) for p, g, s in zip((self.w, self.v, self.b), slopes, squares))

        self.scale, self.shift = 1.0, 0.0

    def calibrate(self, rows, entries, patterns, y, steps: int = 50) -> None:
        """The scale and shift of the outputs that make the labels likeliest, by damped Newton steps."""
        z = self.raw(rows, entries, patterns)
        x, t = np.stack([z, np.ones(len(z))], axis=1), np.array([1.0, 0.0])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(x @ t, -60, 60)))
            hess = (x * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ x + 0.1 * np.eye(2)
            step = np.linalg.solve(hess, x.T @ (y - p) - 0.1 * (t - [1.0, 0.0]))
            t = t + step * min(1.0, 1.0 / max(np.abs(step).max(), 1e-12))
        self.scale, self.shift = max(float(t[0]), 0.05), float(t[1])

    def raw(self, rows, entries, patterns):
        return self.b + patterns @ self.v + np.bincount(rows, self.w[entries], len(patterns))

    def predict(self, rows, entries, patterns):
        z = self.scale * self.raw(rows, entries, patterns) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


class Model:
    def __init__(self, voters=None, linear=None, share=0.0):
        self.voters, self.linear, self.share = voters, linear, share

    def predict(self, buf, off) -> np.ndarray:
        if self.linear is None:
            return np.full(len(off) - 1, self.share)
        return self.linear.predict(*self.voters.hits(buf, off))


def _hits_part(sent):
    def run(batches):
        for batch in batches:
            buf, off = B.utf8(batch.column(0))
            for a, b in B.chunks(off):
                rows, entries, patterns = sent.value.hits(buf[off[a] : off[b]], off[a : b + 1] - off[a])
                cut = np.searchsorted(rows, np.arange(b - a + 1))
                own = [entries[cut[i] : cut[i + 1]].astype("<i4").tobytes() for i in range(b - a)]
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary()), pa.array([p.tobytes() for p in patterns], pa.binary()), batch.column(1).slice(a, b - a)], names=["entries", "patterns", "y"])

    return run


def train(docs: DataFrame, labels: DataFrame, *, label="toxic", most: int = MAX_TRAINING_ROWS) -> Model:
    sample = labelled(docs, labels, label, most=most)
    counts = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    clean, toxic = counts.get(0, 0), counts.get(1, 0)
    if not clean or not toxic:
        return Model(share=float(toxic > 0))
    slots, of = lexicon(sample)
    voters = Voters(slots, of)
    got = sample.mapInArrow(_hits_part(sample.sparkSession.sparkContext.broadcast(voters)), "entries binary, patterns binary, y int").toArrow()
    pairs = sorted(zip(got["entries"].to_pylist(), got["patterns"].to_pylist(), got["y"].to_pylist()))  # the same model however the rows arrive
    patterns = np.frombuffer(b"".join(p for _, p, _ in pairs), bool).reshape(-1, len(PATTERNS))
    rows = np.repeat(np.arange(len(pairs)), [len(e) // 4 for e, *_ in pairs])
    entries = np.frombuffer(b"".join(e for e, *_ in pairs), "<i4")
    marks = np.array([y for *_, y in pairs])
    model = LabelModel(voters.votes(rows, entries, patterns), toxic / (clean + toxic))
    linear = Linear(len(slots), rows, entries, patterns, model.labels)
    linear.calibrate(rows, entries, patterns, marks.astype(float))
    return Model(voters, linear)


def score(df: DataFrame, model: Model, *, text_col="text", score_col="score") -> DataFrame:
    """``df`` with ``score_col``."""
    names = [c for c in df.columns if c != score_col]
    kept = df.select(*names)
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            buf, off = B.utf8(batch.column(names.index(text_col)))
            for a, b in B.chunks(off):
                p = sent.value.predict(buf[off[a] : off[b]], off[a : b + 1] - off[a])
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns), pa.array(p)], names=[*names, score_col])

    return kept.mapInArrow(run, kept.withColumn(score_col, F.lit(None).cast("double")).schema)


def query(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    done = score(docs, model).drop("text")
    return done.select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
