"""Language identification by interpolated Kneser-Ney character models.

A text becomes a run of lower-case letters with single spaces for everything between them. Four letters of 16 bits make one
64-bit key (letters beyond U+FFFE share one code), so a key is a perfect hash of its gram. Keys of all training texts are counted inside
the tasks, summed in Spark, and lower orders get their continuation counts from the distinct grams of the order above. Each order keeps
its grams in a sorted key array with one log probability per language.

A gram is kept if its count is at least `min_share` of its language's and order's total. So an order has at most 1 / min_share grams of a
language, whatever the corpus: the model that is collected and broadcast holds at most orders x languages / min_share entries. The mass of
grams left out goes to the lower order, so every model stays a distribution.

Cases: null text and text without letters are `und` with score 0; rows with null lang teach nothing; without any training row all
texts are `und`; ties go to the first language in alphabetical order; repeated rows count as often as they come; other columns are
never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewarden.llm.common import steps, utf8
from sitewarden.session import stage

UND = "und"
ORDER = 4
MIN_SHARE = 1e-5
MAX_LANGUAGES = 256
SYMBOLS = 65_536
# a task hands on its counts when it holds so many different ones
FLUSH = 1_000_000
STEP_BYTES = 500_000  # a step holds about a hundred bytes for each of text
SLOT_BITS = 20


@lru_cache(maxsize=1)
def letter_codes() -> np.ndarray:
    """For each code point its lower-case letter, 0 for anything that is not a letter."""
    codes = np.zeros(0x110000, dtype=np.uint16)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            codes[point] = min(ord(char.lower()[0]), SYMBOLS - 1)
    return codes


def letter_runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all texts with ORDER - 1 spaces before each and one after, the places to predict, and how many of them each text has."""
    pad = ORDER - 1
    joined = b"\n" + b"\n".join(texts) + b"\n"
    points = np.frombuffer(joined.decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    codes = letter_codes()[points]
    lengths = np.fromiter((len(t.decode("utf-8", "replace")) for t in texts), dtype=np.int64, count=len(texts))
    marks = np.concatenate([[0], np.cumsum(lengths + 1)])
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    place = (np.cumsum(keep) - 1)[marks]
    codes = codes[keep]
    codes = np.insert(codes, np.repeat(place, pad - 1), 0)
    place = place + np.arange(len(place)) * (pad - 1)
    counts = place[1:] - place[:-1] - (pad - 1)
    wanted = np.ones(len(codes), dtype=bool)
    wanted[0] = False
    for i in range(1, pad):
        wanted[place + i] = False
    # a text without letters shares its space with its neighbour: nothing to predict
    return codes, np.flatnonzero(wanted[: place[-1] + 1]), counts


def keys_at(codes: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
    """Key of the gram of `order` letters that ends at each place."""
    key = codes[at].astype(np.uint64)
    for i in range(1, order):
        key |= codes[at - i].astype(np.uint64) << np.uint64(16 * i)
    return key


def tally(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their counts, or sums of weights."""
    if weights is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, weights = keys[order], weights[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    sums = np.diff(np.append(starts, len(keys))) if weights is None else np.add.reduceat(weights, starts) if len(keys) else weights
    return keys[starts], sums


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def fold() -> int:
        """Merge the counts of the steps; how many are left."""
        for lang, parts in held.items():
            held[lang] = [tally(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))]
        return sum(len(parts[0][0]) for parts in held.values())

    def out() -> Iterator[pa.RecordBatch]:
        fold()
        for lang, [(keys, n)] in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"]
            )
        held.clear()

    for batch in batches:
        for part in steps(batch, limit=STEP_BYTES):
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(part.column("lang").to_pylist(), utf8(part.column("text")), strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                codes, at, _ = letter_runs(texts)
                found = tally(keys_at(codes, at, ORDER))
                held.setdefault(lang, []).append(found)
                size += len(found[0])
                if size > FLUSH:
                    size = fold()
                    if 2 * size > FLUSH:
                        yield from out()
                        size = 0
    yield from out()


def gram_counts(texts: DataFrame) -> DataFrame:
    """(lang, gram, n): how often each gram of ORDER letters occurs in the texts of each language."""
    rows = texts.select("lang", "text").where("lang is not null and text is not null")
    return rows.mapInArrow(_count_task, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _levels(top: DataFrame, min_share: float) -> DataFrame:
    """(lang, k, gram, alpha) of the kept grams of every order: the discounted share of a gram after its context."""
    out, level = None, top
    for k in range(ORDER, 0, -1):
        stats = level.groupBy("lang").agg(
            F.sum("n").alias("whole"), F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2")
        )
        cut = F.when(F.col("n1") > 0, F.least(F.lit(0.95), F.col("n1") / (F.col("n1") + 2 * F.col("n2")))).otherwise(0.5)
        context = F.shiftrightunsigned("gram", 16)
        contexts = level.groupBy("lang", context.alias("context")).agg(F.sum("n").alias("total"))
        kept = (
            level.join(stats, "lang")
            .where(F.col("n") >= F.lit(min_share) * F.col("whole"))
            .withColumns({"context": context, "cut": cut})
            .join(contexts, ["lang", "context"])
            .select("lang", F.lit(k).alias("k"), "gram", (F.greatest(F.col("n") - F.col("cut"), F.lit(0.0)) / F.col("total")).alias("alpha"))
        )
        out = kept if out is None else out.unionByName(kept)
        mask = (1 << (16 * (k - 1))) - 1
        level = level.groupBy("lang", F.col("gram").bitwiseAND(F.lit(mask)).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
    return out


class Sorted:
    """Sorted keys with a row of values each. A slot table answers most look-ups without the binary search."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values
        self.slots = None

    def __getstate__(self):
        return self.keys, self.values

    def __setstate__(self, state):
        self.__init__(*state)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row of each key, and whether it is there."""
        if not len(self.keys):
            return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
        if self.slots is None:
            self.slots = np.zeros(1 << SLOT_BITS, dtype=np.int32)
            self.slots[self._slot(self.keys)] = np.arange(len(self.keys), dtype=np.int32)
        rows = self.slots[self._slot(keys)]
        there = self.keys[rows] == keys
        rest = np.flatnonzero(~there)
        if len(rest):
            found = np.minimum(np.searchsorted(self.keys, keys[rest]), len(self.keys) - 1)
            rows[rest] = found
            there[rest] = self.keys[found] == keys[rest]
        return rows, there

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


@dataclass
class Model:
    languages: list[str]
    logp: list[Sorted] = field(default_factory=list)  # by order - 1
    gamma: list[Sorted] = field(default_factory=list)  # log weight of the lower order after a context
    slope: tuple[float, float] = (0.0, 1.0)
    limits: dict[tuple[str, int], float] = field(default_factory=dict)
    min_score: float = 0.25

    def score(self, codes: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
        """Log probability of the letter at each place under each language."""
        rows, there = self.logp[order - 1].find(keys_at(codes, at, order))
        if there.all() and len(at):
            return self.logp[order - 1].values[rows]
        out = np.zeros((len(at), len(self.languages)), dtype=np.float32)
        out[there] = self.logp[order - 1].values[rows[there]]
        missed = np.flatnonzero(~there)
        if len(missed):
            out[missed] = self.back_off(codes, at[missed], order)
        return out

    def back_off(self, codes: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
        context = keys_at(codes, at - 1, order - 1) if order > 1 else np.zeros(len(at), dtype=np.uint64)
        rows, there = self.gamma[order - 1].find(context)
        weight = np.zeros((len(at), len(self.languages)), dtype=np.float32)
        weight[there] = self.gamma[order - 1].values[rows[there]]
        lower = self.score(codes, at, order - 1) if order > 1 else np.float32(-np.log(SYMBOLS))
        return weight + lower

    def cross_entropies(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Predicted letters of each text, and nats per letter under each language (inf without letters)."""
        codes, at, counts = letter_runs(texts)
        out = np.full((len(texts), len(self.languages)), np.inf)
        full = np.flatnonzero(counts > 0)
        if len(full) and self.languages:
            starts = (np.cumsum(counts) - counts)[full]
            sums = np.add.reduceat(self.score(codes, at, ORDER), starts, axis=0, dtype=np.float64)
            out[full] = -sums / counts[full, None]
        return counts, out

    def judge(self, texts: list[bytes]) -> dict[str, list]:
        counts, bits = self.cross_entropies(texts)
        out: dict[str, list] = {"lang_pred": [], "score": [], "evidence": [], "letters": [], "nats": [], "rejected": []}
        best = bits.argmin(axis=1) if self.languages else np.zeros(len(texts), dtype=int)
        ordered = np.sort(bits, axis=1)
        for i, n in enumerate(counts.tolist()):
            if n <= 0 or not self.languages:
                row = (UND, 0.0, 0.0, max(n, 0), None, True)
            else:
                lang, nats = self.languages[best[i]], float(ordered[i, 0])
                evidence = min(MAX_EVIDENCE, float(ordered[i, 1] - nats) * n**0.5) if len(self.languages) > 1 else MAX_EVIDENCE
                score = float(1 / (1 + np.exp(-(self.slope[0] + self.slope[1] * evidence))))
                far = nats > self.limits.get((lang, length_class(n)), np.inf)
                row = (lang, score, evidence, n, nats, far or score < self.min_score)
            for column, value in zip(out.values(), row, strict=True):
                column.append(value)
        return out


MAX_EVIDENCE = 40.0
EVIDENCE_STEP = 0.25
JUDGED = "lang_pred string, score double, evidence double, letters bigint, nats double, rejected boolean"


def length_class(n: int) -> int:
    return int(n).bit_length()


def _assemble(rows, languages: list[str]) -> Model:
    """Interpolate the orders from the lowest up."""
    model = Model(languages)
    index = {lang: i for i, lang in enumerate(languages)}
    for k in range(1, ORDER + 1):
        part = rows[rows.k == k]
        keys, inverse = np.unique(part.gram.to_numpy().astype(np.int64).view(np.uint64), return_inverse=True)
        alpha = np.zeros((len(keys), len(languages)))
        alpha[inverse, part.lang.map(index).to_numpy(dtype=int)] = part.alpha.to_numpy()
        contexts, owner = np.unique(keys >> np.uint64(16), return_inverse=True)
        mass = np.zeros((len(contexts), len(languages)))
        np.add.at(mass, owner, alpha)
        # a language that keeps no gram of a context leaves all to the lower order
        model.gamma.append(Sorted(contexts, np.log(np.clip(1 - mass, 1e-9, 1)).astype(np.float32)))
        model.logp.append(Sorted(np.zeros(0, dtype=np.uint64), np.zeros((0, len(languages)), dtype=np.float32)))
        # as texts of k letters: the places to score are the last ones
        codes = np.stack([(keys >> np.uint64(16 * i)) & np.uint64(0xFFFF) for i in range(k - 1, -1, -1)], axis=1) if len(keys) else np.zeros((0, k), dtype=np.uint64)
        at = np.arange(len(keys)) * k + k - 1
        lower = model.back_off(codes.ravel(), at, k) if len(keys) else np.zeros((0, len(languages)))
        model.logp[k - 1] = Sorted(keys, np.log(alpha + np.exp(lower)).astype(np.float32))
    return model


def fit(training: DataFrame, calibration: DataFrame, min_share: float = MIN_SHARE, min_score: float = 0.25, max_sd: float = 8.0) -> Model:
    """Learn from (text, lang) rows.

    `training` is counted. `calibration` turns evidence into the probability of being right, and gives per language and length class the
    cross-entropy beyond which a text is rejected: mean plus `max_sd` deviations. Both are read in full.
    """
    rows = _levels(stage(gram_counts(training), "grams"), min_share).toPandas()
    languages = sorted(rows.lang.unique())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"{len(languages)} languages; the model is bounded for {MAX_LANGUAGES}")
    model = _assemble(rows, languages)
    model.min_score = min_score
    if not languages:
        return model
    judged = (
        judge(calibration.where("lang is not null").select("text", "lang"), model, "lang")
        .where("letters > 0")
        .select(
            (F.col("lang") == F.col("lang_pred")).alias("right"),
            "lang_pred",
            "nats",
            (F.floor(F.log2("letters")) + 1).cast("int").alias("length"),
            F.round(F.col("evidence") / EVIDENCE_STEP).cast("int").alias("bin"),
        )
    )
    found = judged.groupBy("lang_pred", "length", "bin", "right").agg(F.count(F.lit(1)).alias("n"), F.sum("nats").alias("s"), F.sum(F.col("nats") ** 2).alias("q")).toPandas()
    model.slope = _logistic(found.bin.to_numpy() * EVIDENCE_STEP, found.right.to_numpy(dtype=float), found.n.to_numpy(dtype=float))
    good = found[found.right].groupby(["lang_pred", "length"])[["n", "s", "q"]].sum()
    for (lang, length), (n, s, q) in good.iterrows():
        if n >= 20:
            sd = max(q / n - (s / n) ** 2, 0) ** 0.5
            model.limits[lang, int(length)] = s / n + max_sd * max(sd, 0.05)
    return model


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Weighted logistic fit by Newton steps; one wrong answer without evidence and one right at full evidence keep it finite."""
    x, y, w = np.append(x, [0.0, MAX_EVIDENCE]), np.append(y, [0.0, 1.0]), np.append(w, [1.0, 1.0])
    a, b = 0.0, 0.1
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        grad = np.array([np.sum(w * (y - p)) - 1e-3 * a, np.sum(w * (y - p) * x) - 1e-3 * b])
        v = w * p * (1 - p)
        hess = np.array([[v.sum() + 1e-3, (v * x).sum()], [(v * x).sum(), (v * x * x).sum() + 1e-3]])
        step = np.linalg.solve(hess, grad)
        a, b = a + np.clip(step[0], -2, 2), b + np.clip(step[1], -2, 2)
    return float(a), float(max(b, 0.0))


def judge(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """The kept columns of each row with the verdict on its text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.col("text"))
    schema = rows.select(*keep).schema.simpleString()[7:-1].replace(":", " ") if keep else ""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, limit=STEP_BYTES):
                columns = [part.column(c) for c in keep]
                verdict = shared.value.judge(utf8(part.column("text")))
                kinds = [pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.float64(), pa.bool_()]
                arrays = [pa.array(v, kind) for v, kind in zip(verdict.values(), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*columns, *arrays], [*keep, *verdict])

    return rows.mapInArrow(task, f"{schema}, {JUDGED}" if schema else JUDGED)


def keep_identified(docs: DataFrame, model: Model) -> DataFrame:
    """The rows whose text is not rejected, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, limit=STEP_BYTES):
                rejected = shared.value.judge(utf8(part.column("text")))["rejected"]
                yield part.filter(pa.array([not r for r in rejected], pa.bool_()))

    return docs.mapInArrow(task, docs.schema)


def remainder(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4: 2 is held out, 3 calibrates, the others train."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def fit_documents(docs: DataFrame) -> Model:
    fold = F.coalesce(remainder(), F.lit(0))
    return fit(docs.where(fold < 2), docs.where(fold == 3))
