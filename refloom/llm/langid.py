"""Language identification: blended-spectrum presence kernel, Nyström landmarks, one-versus-rest kernel ridge regression.

A text is the set of its character n-grams of one, two and three letters (lower case, every run of other characters is one gap). The kernel
of two texts is the number of n-grams both have, over the geometric mean of their numbers. Some texts of each language are
landmarks; the Nyström map turns kernel values with them into features, and ridge regression of each language against the
rest is solved there. Batches of documents are scored by one matrix product of their presence matrix.

The model learns from a bounded sample: ``PER_LANGUAGE`` different texts of each language, chosen by hash, shorter ones first where some exceed
``LONG`` characters; with more than ``LANGUAGES`` languages, fewer texts of each. Only the n-gram sets of these reach the driver. Scoring reads whole texts.

Defined results: NULL texts and texts without a letter are ``und`` with score 0; so is everything when there is nothing to learn
from. Rows with a NULL id are held out. Repeated rows are kept. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refloom.llm.common import materialize, remainder, unique

SIZES = (1, 2, 3)
#: Texts of each language that the model learns from, and how many of them are landmarks.
PER_LANGUAGE, LANDMARKS = 250, 40
LONG = 20_000
#: Languages up to which each one gives that many texts; it bounds the sample.
LANGUAGES = 1_000
RIDGE = 1e-2
#: How sharply regression outputs (about -1 to 1) become shares.
SHARPNESS = 6.0
UNKNOWN = "und"
#: Characters of a text, and documents, that are handled at once; only a matter of memory.
STRETCH, BATCH = 1 << 20, 128

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _LETTERS[0]


def grams(text: str | None) -> np.ndarray:
    """Distinct n-grams of a whole text as numbers, ascending; empty without a letter."""
    out = np.empty(0, np.uint64)
    text = (text or "").lower()
    widest, found = SIZES[-1], False
    carried = np.array([32], np.uint64)
    for at in range(0, max(1, len(text)), STRETCH):
        part = np.frombuffer(text[at : at + STRETCH].encode("utf-32-le", "surrogatepass"), "<u4")
        letter = _letters()[part]
        found |= bool(letter.any())
        # A gap of any length is one character; the last characters go on into the next stretch.
        kept = letter | np.r_[carried[-1:] != 32, letter[:-1]][: len(part)]
        chars = np.r_[carried, np.where(letter, part, 32)[kept]]
        if at + STRETCH >= len(text) and chars[-1] != 32:
            chars = np.r_[chars, np.uint64(32)]
        chars = chars.astype(np.uint64)
        keys = [chars]
        for n in SIZES[1:]:
            keys.append((keys[-1][:-1] << np.uint64(21)) | chars[n - 1 :])
        out = unique(np.concatenate([out, *keys]))
        carried = chars[1 - widest :]
    return out if found else out[:0]


class Model:
    """Learned languages, known n-grams and their weights."""

    def __init__(self, langs: list[str], known: np.ndarray, weights: np.ndarray, constant: np.ndarray):
        self.langs, self.known, self.weights, self.constant = langs, known, weights, constant

    @staticmethod
    def fit(rows: list[tuple[str, str | np.ndarray]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
        """Learn from pairs of a language and a text, or its n-gram set."""
        sets = [(lang, g) for lang, g in ((lang, grams(x) if isinstance(x, str) else x) for lang, x in rows) if len(g)]
        if not sets:
            return None
        langs = sorted({lang for lang, _ in sets})
        taken: dict[str, int] = {}
        marks = []
        for lang, g in sets:
            taken[lang] = taken.get(lang, 0) + 1
            if taken[lang] <= landmarks:
                marks.append(g)
        known = unique(np.concatenate(marks))
        # Presence of known n-grams over the root of a text's number of n-grams: products of rows are kernel values.
        present = np.zeros((len(marks), len(known)), np.float32)
        for row, g in zip(present, marks, strict=True):
            row[np.searchsorted(known, g)] = 1 / np.sqrt(len(g))
        values, vectors = np.linalg.eigh((present @ present.T).astype(float))
        kept = values > 1e-6 * values[-1]
        root = vectors[:, kept] / np.sqrt(values[kept])
        kernel = np.concatenate([presence(part, known) @ present.T for part in _batches([g for _, g in sets])])
        features = np.c_[kernel @ root, np.ones(len(sets))]
        target = np.where(np.array([[lang == x for x in langs] for lang, _ in sets]), 1.0, -1.0)
        # Languages count alike, however many rows each has.
        share = np.array([1 / taken[lang] for lang, _ in sets])[:, None]
        gram = features.T @ (features * share) + ridge / len(langs) * np.eye(features.shape[1])
        solution = np.linalg.solve(gram, features.T @ (target * share))
        weights = present.T @ (root @ solution[:-1]).astype(np.float32)
        return Model(langs, known, weights, solution[-1].astype(np.float32))

    def score(self, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Position of the best language and its share, per set of n-grams."""
        out = presence(sets, self.known) @ self.weights + self.constant
        shares = np.exp(SHARPNESS * (out - out.max(1, keepdims=True)))
        shares /= shares.sum(1, keepdims=True)
        best = out.argmax(1)
        return best, shares[np.arange(len(sets)), best].astype(float)


def presence(sets: list[np.ndarray], known: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sets), len(known)), np.float32)
    for row, g in zip(out, sets, strict=True):
        if len(g):
            at = np.minimum(np.searchsorted(known, g), len(known) - 1)
            row[at[known[at] == g]] = 1 / np.sqrt(len(g))
    return out


def _batches(items: list, size: int = BATCH) -> list[list]:
    return [items[k : k + size] for k in range(0, len(items), size)]


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> list[tuple[str, np.ndarray]]:
    """N-gram sets of at most ``per_language`` different texts of each language from ``docs`` (text, lang), chosen by hash.

    Where there are more than ``LANGUAGES`` languages, each gives so many fewer texts, so that none is left out.
    """
    rows = docs.filter("lang IS NOT NULL AND text RLIKE '\\\\p{L}'").withColumn("pick", F.xxhash64("text", F.lit(1)))
    # Copies pass or fail together, so texts are counted once.
    counts = rows.groupBy("lang", "pick").agg(F.lit(1)).groupBy("lang").agg(F.count("*").alias("n"))
    counts = materialize(counts, "languages")
    per_language = max(1, min(per_language, LANGUAGES * PER_LANGUAGE // max(1, counts.count())))
    # A few times the wanted number pass by hash, so that the ranking sees a bounded number of rows per language.
    share = (F.col("pick").cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    some = rows.join(counts, "lang").filter(share * F.col("n") <= 6 * per_language).dropDuplicates(["lang", "pick"])
    order = Window.partitionBy("lang").orderBy((F.length("text") > LONG), "pick", "text")
    chosen = some.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= per_language)

    @F.pandas_udf("binary")
    def sets(texts: pd.Series) -> pd.Series:
        return pd.Series([grams(t).tobytes() for t in texts.tolist()])

    got = [(r["lang"], r["nth"], np.frombuffer(r["grams"], np.uint64)) for r in chosen.select("lang", "nth", sets("text").alias("grams")).collect()]
    return [(lang, g) for lang, _, g in sorted(got, key=lambda r: r[:2])]


def identify(
    docs: DataFrame, held_out_mod: int = 5, held_out_rest: int = 0, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    per_language: int = PER_LANGUAGE,
) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every document; learns from those not held out."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    held_out = F.coalesce(remainder(F.col("doc_id"), held_out_mod) == held_out_rest, F.lit(True))
    model = Model.fit(sample(rows.filter(~held_out).select("text", "lang"), per_language))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        model, names, scores = shared.value, [], []
        for part in _batches(texts.tolist()):
            sets = [grams(t if isinstance(t, str) else None) for t in part]
            if model is None:
                best, share = np.zeros(len(sets), int), np.zeros(len(sets))
            else:
                best, share = model.score(sets)
            known = [bool(len(g)) and model is not None for g in sets]
            names += [model.langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), known, strict=True)]
            scores += [s if k else 0.0 for s, k in zip(share.tolist(), known, strict=True)]
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return rows.select("doc_id", held_out.alias("held_out"), predict("text").alias("p")).select("doc_id", "held_out", "p.*")
