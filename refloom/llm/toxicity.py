"""Toxicity: a bidirectional gated recurrent network with attention pooling over word and character inputs, in numpy.

A word enters the network as its own vector (for words that several learning texts have) and as the sum of vectors of its character
n-grams, with the word's ends marked, so that an unseen word counts by its parts. Windows of 16 words, overlapping by 4, cover
the whole text; each runs forwards and backwards through gated recurrent cells, attention pools the states, and a logistic
unit scores the pool. A document is as toxic as its worst window; a last logistic fit on the learning documents turns that into a
probability.

The network learns from a bounded sample of labelled documents (``SAMPLE`` of each label, chosen by hash). Which windows make a document
toxic is not known: at first those with the words and n-grams that toxic documents have most in excess are taken, then those that the
network itself holds for the worst. Clean documents give their worst windows and random ones. Scoring reads whole texts, every word and
every window.

Defined results: NULL and empty texts have one empty window, and so the lowest score there is without words. Rows with a NULL id are held out. Without both
labels to learn from every score is 0. Several labels of a document count as toxic if one is. Repeated rows are kept. An empty table gives
an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refloom.llm.common import blocks, remainder, unique

THRESHOLD = 0.3
#: Labelled documents of each label that the network learns from, and windows that each of them gives.
SAMPLE, WINDOWS = 1500, 6
LENGTH, STEP = 16, 12
HIDDEN, WORD_SIZE, GRAM_SIZE, ATTENTION = 8, 8, 16, 8
SIZE = WORD_SIZE + GRAM_SIZE
#: Words and n-grams have vectors where so many learning documents have them.
LEAST_WORD, LEAST_GRAM = 4, 6
BUCKETS = 1 << 16
#: Learning rate of the vectors; logit under which a document marked toxic is taken for marked by mistake, once the network has learnt a little.
VECTOR_RATE, DOUBT = 60.0, -1.5
GRAMS = (3, 4, 5)
#: Longer words count as several.
LONGEST = 24
#: Distinct words whose inputs a Python worker remembers, bytes of texts and windows that are scored at once.
REMEMBERED, STRETCH, BATCH = 150_000, 1 << 21, 2048
CHUNK = 20_000

_STRIP = b".,;:!?\"'()[]{}<>*#%&$@|-_=+~`/\\^"


def words_of(text: str | None) -> list[bytes]:
    """All words of a text, lower case, without marks around them."""
    out = []
    for block in blocks((text or "").lower().encode("utf-8", "replace")):
        for w in block.split():
            w = w.strip(_STRIP) or w
            if len(w) <= LONGEST:
                out.append(w)
            else:
                out += [w[k : k + LONGEST] for k in range(0, len(w), LONGEST)]
    return out


def gram_buckets(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of some words, word after word, and where each word's begin."""
    length = np.array([len(w) for w in words]) + 2
    width = LONGEST + 2
    chars = np.frombuffer(b"".join([(b"\x02" + w + b"\x03").ljust(width, b"\0") for w in words]), np.uint8).reshape(-1, width)
    chars = chars.astype(np.uint64) + np.uint64(1)
    parts, valid = [], []
    for n in GRAMS:
        h = np.full((len(words), width - n + 1), n, np.uint64)
        for k in range(n):
            h = (h ^ chars[:, k : k + width - n + 1]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        parts.append(h % np.uint64(BUCKETS))
        valid.append(np.arange(width - n + 1) < (length - n + 1)[:, None])
    ok = np.concatenate(valid, 1)
    return np.concatenate(parts, 1)[ok].astype(np.int64), np.r_[0, np.cumsum(ok.sum(1))]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


class Network:
    """Weights, and the forward and backward passes over windows of word rows (row 0 stands for no word)."""

    def __init__(self, words: dict[bytes, int], active: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        h, d, a = HIDDEN, SIZE, ATTENTION

        def start(*shape):
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.words, self.active = words, active
        # Vectors start at zero, so those that never learn say nothing.
        self.p = {
            "word": np.zeros((len(words) + 1, WORD_SIZE), np.float32), "gram": np.zeros((BUCKETS, GRAM_SIZE), np.float32),
            "wf": start(d, 3 * h), "uf": start(h, 3 * h), "bf": np.zeros(3 * h, np.float32),
            "wb": start(d, 3 * h), "ub": start(h, 3 * h), "bb": np.zeros(3 * h, np.float32),
            "att": start(2 * h, a), "ab": np.zeros(a, np.float32), "av": start(a), "out": start(2 * h), "ob": np.zeros(1, np.float32),
        }
        self.slope, self.shift = 1.0, 0.0

    def inputs(self, words: list[bytes]) -> tuple[np.ndarray, tuple]:
        """Input vectors of words."""
        buckets, starts = gram_buckets(words)
        keep = self.active[buckets]
        owner = np.repeat(np.arange(len(words)), np.diff(starts))[keep]
        buckets = buckets[keep]
        number = np.bincount(owner, minlength=len(words))
        scale = (1 / np.sqrt(np.maximum(1, number))).astype(np.float32)
        sums = np.zeros((len(words), GRAM_SIZE), np.float32)
        if len(buckets):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sums[owner[first]] = np.add.reduceat(self.p["gram"][buckets], first, axis=0)
        rows = np.array([self.words.get(w, 0) for w in words])
        x = np.concatenate([self.p["word"][rows] * (rows > 0)[:, None].astype(np.float32), sums * scale[:, None]], 1)
        return x, (rows, buckets, owner, scale)

    def run(self, tables: tuple[np.ndarray, np.ndarray], at: np.ndarray, keep: bool = False):
        """Scores (logits) of windows ``at`` (rows of the projected input tables, 0 for no word)."""
        p, h, n = self.p, HIDDEN, len(at)
        mask = (at > 0).astype(np.float32)
        states = np.empty((LENGTH, n, 2 * h), np.float32)
        trace = []
        for side, (table, u) in enumerate(zip(tables, (p["uf"], p["ub"]), strict=True)):
            s = np.zeros((n, h), np.float32)
            order = range(LENGTH) if side == 0 else range(LENGTH - 1, -1, -1)
            for t in order:
                x = table[at[:, t]]
                zr = sigmoid(x[:, : 2 * h] + s @ u[:, : 2 * h])
                z, r = zr[:, :h], zr[:, h:]
                c = np.tanh(x[:, 2 * h :] + (r * s) @ u[:, 2 * h :])
                m = mask[:, t, None]
                new = s + m * z * (c - s)
                if keep:
                    trace.append((side, t, s, z, r, c, m))
                s = new
                states[t, :, side * h : (side + 1) * h] = s
        e = np.tanh(states @ p["att"] + p["ab"])
        a = e @ p["av"] + np.where(mask.T > 0, np.float32(0), np.float32(-30))
        a = np.exp(a - a.max(0))
        a /= a.sum(0)
        pool = (a[:, :, None] * states).sum(0) * mask.any(1)[:, None]
        logit = pool @ p["out"] + p["ob"]
        return (logit, (mask, states, trace, e, a, pool)) if keep else logit

    def tables(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = self.p
        return x @ p["wf"] + p["bf"], x @ p["wb"] + p["bb"]

    def gradients(self, words: list[bytes], at: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean logistic loss; ``at`` numbers ``words`` from 1."""
        p, h, n = self.p, HIDDEN, len(at)
        x, (rows, buckets, owner, scale) = self.inputs(words)
        x = np.concatenate([np.zeros((1, SIZE), np.float32), x])
        tables = self.tables(x)
        logit, (mask, states, trace, e, a, pool) = self.run(tables, at, True)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        d = ((sigmoid(logit) - target) / n).astype(np.float32)
        g["out"], g["ob"] = pool.T @ d, d.sum(keepdims=True)
        dpool = d[:, None] * p["out"] * mask.any(1)[:, None]
        da = (states * dpool).sum(2)
        ds = a[:, :, None] * dpool
        de = a * (da - (a * da).sum(0))
        g["av"] = np.einsum("tna,tn->a", e, de)
        dpre = (1 - e * e) * (de[:, :, None] * p["av"])
        g["att"] = np.einsum("tnh,tna->ha", states, dpre)
        g["ab"] = dpre.sum((0, 1))
        ds += dpre @ p["att"].T
        dtables = [np.zeros_like(t) for t in tables]
        carry = [np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)]
        for side, t, s, z, r, c, m in reversed(trace):
            uk = "uf" if side == 0 else "ub"
            u = p[uk]
            dnew = carry[side] + ds[t, :, side * h : (side + 1) * h]
            dz = dnew * m * (c - s) * z * (1 - z)
            dc = dnew * m * z * (1 - c * c)
            drs = dc @ u[:, 2 * h :].T
            dr = drs * s * r * (1 - r)
            dzr = np.concatenate([dz, dr], 1)
            g[uk][:, : 2 * h] += s.T @ dzr
            g[uk][:, 2 * h :] += (r * s).T @ dc
            carry[side] = dnew * (1 - m * z) + drs * r + dzr @ u[:, : 2 * h].T
            dx = np.concatenate([dzr, dc], 1)
            order = np.argsort(at[:, t], kind="stable")
            row = at[order, t]
            first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            dtables[side][row[first]] += np.add.reduceat(dx[order], first, axis=0)
        for side, k in enumerate("fb"):
            dt = dtables[side]
            dt[0] = 0
            g["w" + k], g["b" + k] = x.T @ dt, dt.sum(0)
        dx = (dtables[0] @ p["wf"].T + dtables[1] @ p["wb"].T)[1:]
        np.add.at(g["word"], rows, dx[:, :WORD_SIZE])
        g["word"][0] = 0
        if len(buckets):
            order = np.argsort(buckets, kind="stable")
            b = buckets[order]
            first = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
            g["gram"][b[first]] = np.add.reduceat((dx[:, WORD_SIZE:] * scale[:, None])[owner[order]], first, axis=0)
        return g


def window_rows(numbers: np.ndarray) -> np.ndarray:
    """All windows over a document's word numbers; the last one ends with the text."""
    n = len(numbers)
    if n <= LENGTH:
        return np.r_[numbers, np.zeros(LENGTH - n, numbers.dtype)][None]
    starts = np.r_[np.arange(0, n - LENGTH, STEP), n - LENGTH]
    return numbers[starts[:, None] + np.arange(LENGTH)]


class Scorer:
    """Scores texts with a network, remembering the inputs of words."""

    def __init__(self, net: Network):
        self.net = net
        self.forget()

    def forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.size = 1
        self.projected = [np.zeros((4096, 3 * HIDDEN), np.float32) for _ in range(2)]

    def learn(self, words: list[bytes]) -> None:
        new = list(set(words).difference(self.number))
        if not new:
            return
        if self.size + len(new) > REMEMBERED and self.number:
            self.forget()
            new = list(set(words))
        while self.size + len(new) > len(self.projected[0]):
            self.projected = [np.concatenate([t, np.zeros_like(t)]) for t in self.projected]
        for k in range(0, len(new), CHUNK):
            part = new[k : k + CHUNK]
            for table, got in zip(self.projected, self.net.tables(self.net.inputs(part)[0]), strict=True):
                table[self.size : self.size + len(part)] = got
            self.number.update(zip(part, range(self.size, self.size + len(part)), strict=True))
            self.size += len(part)

    def windows(self, texts: list[str | None]) -> list[np.ndarray]:
        """Logits of all windows, per text."""
        split = [words_of(t) for t in texts]
        self.learn([w for s in split for w in s])
        known = self.number
        rows = [window_rows(np.fromiter(map(known.__getitem__, s), np.int64, len(s))) for s in split]
        at = np.concatenate(rows)
        logits = np.concatenate([self.net.run(self.projected, at[k : k + BATCH]) for k in range(0, len(at), BATCH)])
        return np.split(logits, np.cumsum([len(r) for r in rows])[:-1])

    def worst(self, texts: list[str | None]) -> np.ndarray:
        """Logit of each text's worst window."""
        out, part, size = [], [], 0
        for k, t in enumerate(texts):
            part.append(t)
            size += len(t or "")
            if size >= STRETCH or k == len(texts) - 1:
                out += [float(x.max()) for x in self.windows(part)]
                part, size = [], 0
        return np.array(out)

    def probability(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.net.slope * self.worst(texts) + self.net.shift, -30, 30)))


def excess(listed: list[bytes], docs: list[np.ndarray], target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log odds of toxicity that each word, or one of its n-grams, suggests; words and n-grams with enough documents.

    ``docs`` are numbers of words, from 1.
    """
    words, toxic_words = np.zeros(len(listed) + 1), np.zeros(len(listed) + 1)
    grams, toxic_grams = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for d, y in zip(docs, target.tolist(), strict=True):
        own = unique(d)
        words[own] += 1
        toxic_words[own] += y
        if len(own):
            at = unique(gram_buckets([listed[k - 1] for k in own.tolist()])[0])
            grams[at] += 1
            toxic_grams[at] += y
    ones, zeros = target.sum(), (target == 0).sum()

    def odds(toxic, every):
        return np.log((toxic + 1) / (ones + 2)) - np.log((every - toxic + 1) / (zeros + 2))

    gram_odds = np.where(grams >= LEAST_GRAM, odds(toxic_grams, grams), -9.0)
    out = np.where(words >= LEAST_WORD, odds(toxic_words, words), -9.0)
    for k in range(0, len(listed), CHUNK):
        buckets, starts = gram_buckets(listed[k : k + CHUNK])
        part = slice(k + 1, k + len(starts))
        out[part] = np.maximum(out[part], np.maximum.reduceat(gram_odds[buckets], starts[:-1]))
    return out, words >= LEAST_WORD, grams >= LEAST_GRAM


def logits(net: Network, listed: list[bytes], windows: list[np.ndarray]) -> list[np.ndarray]:
    """Logits of the learning documents' windows."""
    tables = [np.zeros((len(listed) + 1, 3 * HIDDEN), np.float32) for _ in range(2)]
    for k in range(0, len(listed), CHUNK):
        part = listed[k : k + CHUNK]
        for table, got in zip(tables, net.tables(net.inputs(part)[0]), strict=True):
            table[k + 1 : k + 1 + len(part)] = got
    return [np.concatenate([net.run(tables, w[k : k + BATCH]) for k in range(0, len(w), BATCH)]) for w in windows]


def fit(rows: list[tuple[str | None, int]], epochs: int = 5, batch: int = 256, rate: float = 0.02, seed: int = 7) -> Network | None:
    """Train on (text, label) pairs; None without both labels."""
    target = np.array([y for _, y in rows], int)
    if len(set(target.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    # Texts are kept as numbers of words only.
    vocabulary: dict[bytes, int] = {}
    docs = [np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(t)], np.int32) for t, _ in rows]
    listed = list(vocabulary)
    del vocabulary
    weight, known, active = excess(listed, docs, target)
    net = Network({w: n for n, w in enumerate((w for w, ok in zip(listed, known[1:].tolist(), strict=True) if ok), 1)}, active, seed)
    windows = [window_rows(d) for d in docs]
    weight[0] = -9.0
    worst = [weight[w].max(1) for w in windows]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items() if k not in ("word", "gram")}
    step = 0
    for epoch in range(epochs):
        if epoch >= 2:
            worst = logits(net, listed, windows)
        chosen, labels = [], []
        for k, w in enumerate(windows):
            order = np.argsort(-worst[k], kind="stable")
            if target[k]:
                if epoch >= 2 and worst[k].max() < DOUBT:
                    continue
                take = order[: max(1, int((worst[k] >= worst[k].max() - 0.5).sum()))][:WINDOWS]
            else:
                take = unique(np.r_[order[: WINDOWS // 3], rng.permutation(len(w))[: WINDOWS - WINDOWS // 3]])
            chosen.append(w[take])
            labels.append(np.full(len(take), target[k], np.float32))
        at, y = np.concatenate(chosen), np.concatenate(labels)
        # The rarer label's windows are repeated.
        one, zero = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
        few, many = (one, zero) if len(one) < len(zero) else (zero, one)
        order = rng.permutation(np.r_[many, rng.choice(few, max(len(few), len(many) // 3))] if len(few) else many)
        for k in range(0, len(order), batch):
            pick = order[k : k + batch]
            numbers, local = np.unique(at[pick], return_inverse=True)
            local = local.reshape(-1, LENGTH) + (numbers[0] > 0)
            names = [listed[x - 1] for x in numbers.tolist() if x]
            if not names:
                continue
            g = net.gradients(names, local, y[pick])
            step += 1
            for key, grad in g.items():
                if key in ("word", "gram"):
                    # Plain steps: a vector moves as far as it is backed, so that a few odd documents teach little.
                    net.p[key] -= VECTOR_RATE / (1 + epoch) ** 0.5 * grad
                    continue
                m, v = moments[key]
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                net.p[key] -= (rate / (1 + epoch) ** 0.5) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    # The documents' own worst windows, to probabilities: a logistic fit in one variable, a weight of one pseudo-document on each side.
    logit = np.array([float(x.max()) for x in logits(net, listed, windows)])
    soft = np.where(target == 1, 1 - 1 / (target.sum() + 2), 1 / ((target == 0).sum() + 2))
    weights = np.zeros(2)
    x = np.c_[logit, np.ones(len(logit))]
    for _ in range(100):
        q = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        hessian = (x * (q * (1 - q))[:, None]).T @ x + 1e-3 * np.eye(2)
        change = np.linalg.solve(hessian, x.T @ (q - soft) + 1e-3 * weights)
        weights -= change / max(1.0, np.abs(change).max() / 2)
    net.slope, net.shift = float(weights[0]), float(weights[1])
    return net


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, per_label: int = SAMPLE) -> list[tuple[str | None, int]]:
    """Texts and labels of at most ``per_label`` documents of each label, chosen by hash."""
    marked = labels.filter("toxic IS NOT NULL").groupBy(F.col("doc_id").alias("labelled")).agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    pick = F.xxhash64(F.col("labelled").cast("string"), F.lit(3))
    share = (pick.cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    number = F.coalesce(*[F.when(F.col("toxic") == k, F.lit(float(n))) for k, n in counts.items()], F.lit(0.0))
    some = marked.withColumn("pick", pick).filter(share * number <= 2 * per_label)
    order = Window.partitionBy("toxic").orderBy("pick", "labelled")
    some = some.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= per_label)
    texts = docs.select(F.col(id_col).alias("labelled"), F.col(text_col).cast("string").alias("text"))
    got = texts.join(F.broadcast(some), "labelled").select("toxic", "nth", "text").collect()
    return [(r["text"], r["toxic"]) for r in sorted(got, key=lambda r: (r["nth"], r["toxic"], r["text"] or ""))]


def scorer(net: Network | None, docs: DataFrame, text_col: str = "text") -> Column:
    """Column with the probability that a text is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if shared.value is None:
            return pd.Series(np.zeros(len(texts)))
        if not _SCORERS or _SCORERS[0][0] is not shared.value:
            _SCORERS[:] = [(shared.value, Scorer(shared.value))]
        return pd.Series(_SCORERS[0][1].probability([t if isinstance(t, str) else None for t in texts.tolist()]))

    return score(F.col(text_col).cast("string"))


_SCORERS: list = []


def train(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> Network | None:
    """A network from the labelled documents, without those for which ``held_out`` (on the label's doc_id) is true."""
    known = labels if held_out is None else labels.filter(~held_out)
    return fit(sample(docs, known.select("doc_id", "toxic"), id_col, text_col))


def toxicity(
    docs: DataFrame, labels: DataFrame, held_out_mod: int = 4, held_out_rest: int = 2, id_col: str = "doc_id", text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document."""

    def rest(column: Column) -> Column:
        return F.coalesce(remainder(column, held_out_mod) == held_out_rest, F.lit(True))

    net = train(docs, labels, rest(F.col("doc_id")), id_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), rest(F.col(id_col)).alias("held_out"), scorer(net, docs, text_col).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns, that are not toxic; learns from all labels."""
    net = train(docs, labels, None, id_col, text_col)
    return docs.filter(scorer(net, docs, text_col) < threshold)
