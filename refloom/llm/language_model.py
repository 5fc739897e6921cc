"""Language-model scores: hashed maximum-entropy model with n-gram and skip features and a class-factored softmax.

Tokens are lower-cased words and one end per text. The ``FREQUENT`` most frequent tokens stand in classes of ``WIDTH``; every other word belongs to
one of ``SHAPES`` classes by its ending. The model gives log P(class | context) + log P(token | class, context): both are softmaxes over sums of
weight rows, for the words one, two and three places back and for hashed pairs of them (adjacent and skipping one). Inside a class of rare
words, probability goes by counts, with a share for unknown words, so that all tokens and one unknown word per class sum to one.

1. Texts are numbered in blocks of bounded size: a block's distinct words once, its texts as numbers. No text is read again.
2. Word counts of the learning documents are summed over the whole corpus.
3. Training runs in rounds. In each, every task of the cluster starts from the shared weights, takes the learning documents of its blocks of that
   round in mini-batches (adaptive steps), and returns the change of the weights; a tree averages the changes. Every
   learning document is used once, so what is gathered grows with the corpus.
4. Counts are joined to the blocks' distinct words, and blocks are scored in sparse batches: rows of weights are looked up and added.

Words are told apart by a 58-bit hash with their class number.

Defined results: NULL and empty texts are one end token. Rows with a NULL id are held out. With nothing to learn from, every known count is 0, the base score is 0
and so is the model's. Repeated rows are kept. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refloom.llm.common import REMEMBERED, blocks, materialize, mix, remainder, tree_reduce

FREQUENT, WIDTH, SHAPES = 1024, 64, 32
CLASSES = FREQUENT // WIDTH + SHAPES
PAIRS, INNER = 4096, 4096
#: Symbols of a context: frequent tokens, classes of rare words, and the place before a text.
SYMBOLS = FREQUENT + SHAPES + 1
START = SYMBOLS - 1
ROWS = 3 * SYMBOLS + 2 * PAIRS
OUTER_PARTS = [0, SYMBOLS, 2 * SYMBOLS, 3 * SYMBOLS, 3 * SYMBOLS + PAIRS, ROWS]
INNER_PARTS = [0, INNER, 2 * INNER]
#: Tokens that are scored at once, and that one step learns from.
BATCH, STEP = 8_192, 65_536
RATE, ROUNDS = 0.2, 2
#: Text of a block, in bytes.
BLOCK_BYTES = 12 << 20
END = np.uint64(SHAPES - 1)  # hash 0 in the last class
_SHAPE = np.uint64(SHAPES - 1)


def word_key(word: bytes) -> int:
    """Hash of a word with its class in the low bits: by its last letters and by a mark after them."""
    bare = word.rstrip(b".,;:!?\"')]|")
    shape = xxhash.xxh32_intdigest(bare[-2:]) % (SHAPES // 2) + SHAPES // 2 * (len(bare) < len(word))
    return (xxhash.xxh3_64_intdigest(word) & ~(SHAPES - 1)) | shape


class WordKeys(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = word_key(word)
        return value


_KEYS = WordKeys()


def token_keys(text: str | None) -> np.ndarray:
    parts = []
    for block in blocks((text or "").encode().lower()):
        words = block.split()
        parts.append(np.fromiter(map(_KEYS.__getitem__, words), np.uint64, len(words)))
    return np.concatenate([*parts, np.array([END])])


_BLOCK = "block long, doc_id array<long>, learn array<boolean>, lengths array<int>, tokens binary, keys binary, counts binary"


def _pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(data)), kind)


def number_block(number: int, ids: list, learn: list[bool], texts: list[np.ndarray]) -> dict:
    """A block of texts as numbers into its distinct keys, the most frequent ones first, with their counts in learning documents."""
    flat = np.concatenate(texts)
    order = np.argsort(flat)
    ranked = flat[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    place = np.empty(len(flat), np.int64)
    place[order] = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(flat)]))
    by_count = np.argsort(-np.diff(np.r_[first, len(flat)]), kind="stable")
    new = np.empty_like(by_count)
    new[by_count] = np.arange(len(by_count))
    tokens = new[place]
    lengths = [len(t) for t in texts]
    learning = np.repeat(np.array(learn, bool), lengths)
    counts = np.bincount(tokens[learning], minlength=len(first))
    return {
        "block": number, "doc_id": ids, "learn": learn, "lengths": lengths, "tokens": _pack(tokens.astype("<u4")),
        "keys": ranked[first][by_count].tobytes(), "counts": counts.astype("<u4").tobytes(),
    }


def numbered(docs: DataFrame) -> DataFrame:
    """Blocks of ``docs`` (doc_id, learn, text), written once."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        ids, learn, texts, size = [], [], [], 0
        for pdf in frames:
            for i, y, t in zip(pdf["doc_id"].astype("Int64"), pdf["learn"].tolist(), pdf["text"].tolist(), strict=True):
                t = t if isinstance(t, str) else ""
                ids.append(None if i is pd.NA else int(i))
                learn.append(bool(y))
                texts.append(token_keys(t))
                size += len(t)
                if size >= BLOCK_BYTES:
                    yield pd.DataFrame([number_block(number, ids, learn, texts)])
                    number += 1
                    ids, learn, texts, size = [], [], [], 0
        if ids:
            yield pd.DataFrame([number_block(number, ids, learn, texts)])

    return materialize(docs.mapInPandas(run, _BLOCK), "blocks")


class Model:
    """Frequent tokens, counts of the classes, and the weights."""

    def __init__(self, frequent: list[tuple[int, int]], rare: dict[int, tuple[int, int]]):
        """``frequent``: (key, count), most frequent first; ``rare``: (tokens, distinct words) by class of the rest."""
        keys = np.array([k for k, _ in frequent], np.int64).view(np.uint64)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        count = np.zeros(FREQUENT)
        count[: len(frequent)] = [n for _, n in frequent]
        tokens = np.array([rare.get(s, (0, 0))[0] for s in range(SHAPES)], float)
        words = np.array([rare.get(s, (0, 0))[1] for s in range(SHAPES)], float)
        self.total, self.distinct = int(count.sum() + tokens.sum()), len(frequent) + int(words.sum())
        self.rare_log = np.log(tokens + 0.5 * (words + 1))
        mass = np.r_[count.reshape(-1, WIDTH).sum(1), tokens + 0.5]
        self.class_bias = np.log(np.maximum(mass, 1e-12) / mass.sum()).astype(np.float32)
        inner = count.reshape(-1, WIDTH)
        self.inner_bias = np.log(np.maximum(inner, 1e-9) / np.maximum(inner.sum(1, keepdims=True), 1e-9)).astype(np.float32)
        self.outer = np.zeros((ROWS, CLASSES), np.float32)
        self.inner = np.zeros((2 * INNER, WIDTH), np.float32)

    def symbols(self, keys: np.ndarray) -> np.ndarray:
        """Frequent tokens by rank, then the classes of rare words."""
        out = FREQUENT + (keys & _SHAPE).astype(np.int32)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = self.keys[at] == keys
            out[hit] = self.order[at[hit]]
        return out

    @staticmethod
    def contexts(symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols one, two and three places back, in texts laid end to end."""
        place = np.arange(len(symbols)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        back = []
        for k in (1, 2, 3):
            q = np.full(len(symbols), START, np.int32)
            q[k:] = symbols[:-k]
            q[place < k] = START
            back.append(q)
        return tuple(back)

    @staticmethod
    def rows(q1: np.ndarray, q2: np.ndarray, q3: np.ndarray) -> list[np.ndarray]:
        q1, q2, q3 = (q.astype(np.int64) for q in (q1, q2, q3))
        near = (mix((q1 * 4099 + q2).astype(np.uint64)) % np.uint64(PAIRS)).astype(np.int64)
        skip = (mix((q1 * 4099 + q3 + (1 << 40)).astype(np.uint64)) % np.uint64(PAIRS)).astype(np.int64)
        return [q1, SYMBOLS + q2, 2 * SYMBOLS + q3, 3 * SYMBOLS + near, 3 * SYMBOLS + PAIRS + skip]

    @staticmethod
    def inner_rows(group: np.ndarray, q1: np.ndarray, q2: np.ndarray) -> list[np.ndarray]:
        group = group.astype(np.int64)
        one = (mix((group * 4099 + q1).astype(np.uint64)) % np.uint64(INNER)).astype(np.int64)
        two = (mix((group * 4099 + q2 + (1 << 40)).astype(np.uint64)) % np.uint64(INNER)).astype(np.int64)
        return [one, INNER + two]

    @staticmethod
    def logits(bias: np.ndarray, table: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
        """Sums of weight rows, the largest of each token taken off."""
        out = table[rows[0]]
        for r in rows[1:]:
            out += table[r]
        out += bias
        out -= out.max(1, keepdims=True)
        return out

    @staticmethod
    def shares(logits: np.ndarray) -> np.ndarray:
        np.exp(logits, out=logits)
        logits /= logits.sum(1, keepdims=True)
        return logits

    @staticmethod
    def log_share(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Logarithm of one share of each row."""
        one = logits[np.arange(len(at)), at]
        return (one - np.log(np.exp(logits, out=logits).sum(1))).astype(float)

    def log_probability(self, symbols: np.ndarray, counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Natural log probability of each token; ``counts`` are the tokens' counts in learning documents."""
        out = np.empty(len(symbols))
        back = self.contexts(symbols, lengths)
        for k in range(0, len(symbols), BATCH):
            s = symbols[k : k + BATCH]
            q1, q2, q3 = (q[k : k + BATCH] for q in back)
            group = np.where(s < FREQUENT, s // WIDTH, FREQUENT // WIDTH + s - FREQUENT)
            logs = self.log_share(self.logits(self.class_bias, self.outer, self.rows(q1, q2, q3)), group)
            common = s < FREQUENT
            g = group[common]
            inner = self.logits(self.inner_bias[g], self.inner, self.inner_rows(g, q1[common], q2[common]))
            logs[common] += self.log_share(inner, s[common] % WIDTH)
            rare = ~common
            logs[rare] += np.log(counts[k : k + BATCH][rare] + 0.5) - self.rare_log[s[rare] - FREQUENT]
            out[k : k + BATCH] = logs
        return out

    def learn(self, symbols: np.ndarray, lengths: np.ndarray, seen: tuple[np.ndarray, np.ndarray]) -> None:
        """Mini-batch steps over texts laid end to end; ``seen`` has the sums of squared gradients."""
        back = self.contexts(symbols, lengths)
        for k in range(0, len(symbols), STEP):
            s = symbols[k : k + STEP]
            q1, q2, q3 = (q[k : k + STEP] for q in back)
            group = np.where(s < FREQUENT, s // WIDTH, FREQUENT // WIDTH + s - FREQUENT)
            rows = self.rows(q1, q2, q3)
            gradient = self.shares(self.logits(self.class_bias, self.outer, rows))
            gradient[np.arange(len(s)), group] -= 1
            common = s < FREQUENT
            g = group[common]
            inner_rows = self.inner_rows(g, q1[common], q2[common])
            inner = self.shares(self.logits(self.inner_bias[g], self.inner, inner_rows))
            inner[np.arange(len(g)), s[common] % WIDTH] -= 1
            _step(self.outer, seen[0], OUTER_PARTS, rows, gradient)
            _step(self.inner, seen[1], INNER_PARTS, inner_rows, inner)


def _step(table: np.ndarray, seen: np.ndarray, parts: list[int], rows: list[np.ndarray], gradient: np.ndarray) -> None:
    """Adaptive step of a table, one kind of feature (a stretch of rows from one bound of ``parts`` to the next) after the other.

    Gradients are summed column by column, so that what they are added to stays in the cache.
    """
    columns = np.ascontiguousarray(gradient.T, dtype=float)
    for low, high, r in zip(parts, parts[1:], rows, strict=False):
        at = r - low
        total = np.stack([np.bincount(at, c, high - low) for c in columns], axis=1).astype(np.float32)
        square = seen[low:high]
        square += total * total
        table[low:high] -= np.float32(RATE) * total / np.sqrt(square + np.float32(1.0))


def _state(model: Model, outer: np.ndarray, inner: np.ndarray, tokens: int) -> bytes:
    """Change of the weights since ``outer`` and ``inner``, times the tokens it comes from, with their number."""
    change = np.concatenate([(model.outer - outer).ravel(), (model.inner - inner).ravel()])
    return np.r_[np.float32(tokens / 1e6), change * np.float32(tokens / 1e6)].astype(np.float32).tobytes()


def _add(states: Iterator[bytes]) -> bytes:
    total = None
    for s in states:
        part = np.frombuffer(bytes(s), np.float32)
        total = part.copy() if total is None else total + part
    return total.tobytes()


def train(model: Model, numbers: DataFrame, rounds: int = ROUNDS) -> Model:
    """Weights after one pass over the learning documents, in rounds of parallel steps."""
    spark = numbers.sparkSession
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        steps = _trainer(shared, turn, rounds)
        part = numbers.select("block", "learn", "lengths", "tokens", "keys")
        states = part.mapInPandas(steps, "part long, state binary")
        total = tree_reduce(states, part.rdd.getNumPartitions(), _add, fan_in=8)
        if total is not None:
            values = np.frombuffer(total, np.float32)
            if values[0] > 0:
                change = values[1:] / values[0]
                size = model.outer.size
                model.outer = model.outer + change[:size].reshape(model.outer.shape)
                model.inner = model.inner + change[size:].reshape(model.inner.shape)
    return model


def _trainer(shared, turn: int, rounds: int):
    def steps(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        start = shared.value
        model = Model.__new__(Model)
        model.__dict__ = start.__dict__ | {"outer": start.outer.copy(), "inner": start.inner.copy()}
        seen, tokens = (np.zeros_like(start.outer), np.zeros_like(start.inner)), 0
        for pdf in frames:
            for row in pdf.itertuples():
                # Blocks of a task take turns.
                if (row.block + (row.block >> 32)) % rounds != turn:
                    continue
                lengths, learn = np.array(row.lengths), np.array(row.learn, bool)
                symbols = model.symbols(np.frombuffer(bytes(row.keys), np.uint64))[_unpack(row.tokens, "<u4")]
                model.learn(symbols[np.repeat(learn, lengths)], lengths[learn], seen)
                tokens += int(lengths[learn].sum())
        if tokens:
            yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "state": [_state(model, start.outer, start.inner, tokens)]})

    return steps


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, held_out_mod: int = 5, held_out_rest: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base and model scores (log10 probabilities) of every document; learns from those not held out."""
    spark = docs.sparkSession
    learn = F.coalesce(remainder(F.col(id_col), held_out_mod) != held_out_rest, F.lit(False))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), learn.alias("learn"), F.col(text_col).cast("string").alias("text"))
    numbers = numbered(rows)

    def words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for row in pdf.itertuples():
                keys, counts = np.frombuffer(bytes(row.keys), np.int64), np.frombuffer(bytes(row.counts), "<u4")
                for k in range(0, len(keys), 50_000):
                    part = keys[k : k + 50_000]
                    yield pd.DataFrame(
                        {"block": row.block, "place": np.arange(k, k + len(part), dtype=np.int32), "key": part, "n": counts[k : k + 50_000].astype(np.int64)}
                    )

    distinct = numbers.select("block", "keys", "counts").mapInPandas(words, "block long, place int, key long, n long")
    counts = materialize(distinct.filter("n > 0").groupBy("key").agg(F.sum("n").alias("c")), "counts")
    frequent = [tuple(r) for r in counts.orderBy(F.desc("c"), "key").limit(FREQUENT).collect()]
    known = spark.createDataFrame([(k,) for k, _ in frequent] or [(0,)], "key long")
    rest = counts.join(F.broadcast(known), "key", "left_anti") if frequent else counts
    shape = F.col("key").bitwiseAND(SHAPES - 1)
    by_shape = rest.groupBy(shape.alias("shape")).agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect()
    model = Model(frequent, {r["shape"]: (r["c"], r["n"]) for r in by_shape})
    model = train(model, numbers)
    shared = spark.sparkContext.broadcast(model)

    def run(counted: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        model, out = shared.value, []
        for row in block.itertuples():
            size = int(counted["place"].max()) + 1
            keys, c = np.empty(size, np.int64), np.zeros(size)
            place = counted["place"].to_numpy()
            keys[place], c[place] = counted["key"].to_numpy(), counted["c"].to_numpy()
            tokens, lengths = _unpack(row.tokens, "<u4"), np.array(row.lengths)
            of = c[tokens]
            starts = np.cumsum(lengths) - lengths
            base = np.log10(of + 0.5) - np.log10(model.total + 0.5 * (model.distinct + 1))
            logs = model.log_probability(model.symbols(keys.view(np.uint64))[tokens], of, lengths) if model.total else base
            out.append(
                pd.DataFrame(
                    {
                        "doc_id": pd.array([None if pd.isna(i) else int(i) for i in row.doc_id], "Int64"),
                        "held_out": ~np.array(row.learn, bool), "n_tokens": lengths, "n_known": np.add.reduceat(of > 0, starts, dtype=np.int64),
                        "train_tokens": model.total, "base_score": np.add.reduceat(base, starts),
                        "score": np.add.reduceat(logs, starts) / (np.log(10) if model.total else 1.0),
                    }
                )
            )
        return pd.concat(out) if out else pd.DataFrame(columns=[c.split()[0] for c in _SCORES.split(", ")])

    counted = distinct.select("block", "place", "key").join(counts, "key", "left").select(
        "block", "place", "key", F.coalesce("c", F.lit(0)).alias("c")
    )
    texts = numbers.select("block", "doc_id", "learn", "lengths", "tokens")
    return counted.groupBy("block").cogroup(texts.groupBy("block")).applyInPandas(run, _SCORES)
