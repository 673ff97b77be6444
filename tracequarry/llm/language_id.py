"""Language identification by hierarchical discrimination.

A text is a vector of hashed byte n-grams.  Linear support vector machines
first tell language families apart; inside the predicted family, one machine
for each pair of its languages votes for the language.

The machines are fitted on all labelled rows that may be learnt from.  The descent starts
at machines of at most ``PER_LANGUAGE`` distinct rows of each language, those with the
smallest hashes of id and text, and takes ``PASSES`` steps over all rows, repeats included:
tasks add up slopes, so nothing but sums reaches the driver.  Where the start has all rows,
it is the result.  Mean vectors and bounds come from all rows as well.  Only text and
language of rows whose crc32(doc_id) modulo 4 isn't 2 are learnt from; the prediction sees
nothing but the text.

Every language of the table is learnt, whatever their number; where there are many
pairs, the machines are fitted by tasks.  A text is of a known language if its
vector is about as near to the mean vector of the language it is given as the
labelled rows are to theirs: :func:`keep_known` drops the others, and keeps all
rows if there is nothing to learn from.

Null texts and texts without a letter are ``und`` with score 0.  Rows with a null
id are predicted, not held out and never learnt from.  With no labelled row at
all everything is ``und``; with one language every text with a letter gets it.
Repeated rows are predicted again; an empty table gives no rows; other columns
are not read by :func:`identify` and kept by :func:`keep_known`.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracequarry.lineage import discard, materialize
from tracequarry.llm.bpe import slices

#: Rows of a language that the descent starts from, and its steps over all rows.
PER_LANGUAGE, PASSES = 400, 40
#: Parts of the range of cosines in which the labelled rows are counted, rows whose slopes are added at once, decimals of weights.
COSINES, ADDED_ROWS, DECIMALS = 4096, 256, 7
#: Pairs of names whose machines the driver fits; more are dealt out to tasks.
LOCAL_PAIRS = 32
#: A text is of no known language below this share of the cosine that this quantile of the labelled rows reaches.
NEAR_SHARE, NEAR_QUANTILE = 0.8, 0.01
#: Hashed n-gram features; n-grams of these many bytes.
FEATURES, GRAMS = 2048, (2, 4)
#: Bytes whose features are counted at once.
BATCH_BYTES, BATCH_ROWS = 1_000_000, 1024
# Families of languages by code. Any other language is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy af lb yi".split(),
    "romance": "fr es it pt ro ca gl oc la".split(),
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk".split(),
    "indic": "hi ur bn pa gu mr ne".split(),
    "turkic": "tr az kk uz ky tt".split(),
    "semitic": "ar he mt am".split(),
    "uralic": "fi et hu".split(),
}


def family(lang: str) -> str:
    """The family of a language code; its own name where the table has none."""
    code = lang.lower().replace("_", "-").split("-")[0]
    return next((f for f, codes in FAMILIES.items() if code in codes), f"={lang}")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


# letters stay, capitals of A-Z become small, all else that is ASCII is a blank
_FOLD = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def counted(texts: list[str | None]) -> np.ndarray:
    """A row for each text: how many of its n-grams have each slot."""
    out = np.zeros((len(texts), FEATURES), np.uint32)
    raw = [(" " + (t or "") + " ").encode("utf-8", "replace").translate(_FOLD) for t in texts]
    a = 0
    while a < len(raw):
        b, size = a, 0
        while b < len(raw) and b - a < BATCH_ROWS and (b == a or size + len(raw[b]) <= BATCH_BYTES):
            size += len(raw[b])
            b += 1
        data = np.frombuffer(b"".join(raw[a:b]), np.uint8).astype(np.uint32)
        lengths = np.array([len(x) for x in raw[a:b]])
        row = np.repeat(np.arange(b - a, dtype=np.int64), lengths)
        counts = np.zeros((b - a) * FEATURES, np.float64)
        for g in GRAMS:
            if len(data) < g:
                continue
            code = data[: len(data) - g + 1].copy()
            for k in range(1, g):
                code *= np.uint32(0x01000193)
                code ^= data[k : len(data) - g + 1 + k]
            code *= np.uint32(0x9E3779B1)
            code >>= np.uint32(32 - (FEATURES.bit_length() - 1))
            inside = row[: len(code)] == row[g - 1 :]
            counts += np.bincount((row[: len(code)] * FEATURES + code)[inside], minlength=len(counts))
        out[a:b] = counts.reshape(b - a, FEATURES)
        a = b
    return out


def features(texts: list[str | None]) -> np.ndarray:
    """A row for each text: square roots of its n-grams' shares, of length 1 (0 without n-grams)."""
    out = np.sqrt(counted(texts).astype(np.float32))
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1)


def fit_machine(x: np.ndarray, y: np.ndarray, steps: int = 150, decay: float = 1e-4) -> np.ndarray:
    """Linear support vector machine (squared hinge loss); y is 1 or -1. Weights, the last is the bias."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w = v = np.zeros(x.shape[1])
    rate = 1 / (4 + decay)
    for t in range(steps):
        slack = np.maximum(0, 1 - y * (x @ v))
        new = v - rate * (decay * v - 2 * (x.T @ (share * y * slack)))
        v = new + t / (t + 3) * (new - w)
        w = new
    return w


def fit_pairs(x: np.ndarray, names: np.ndarray, spark: SparkSession | None = None) -> dict[tuple[str, str], np.ndarray]:
    """One machine for each pair of names: above 0 for the first."""
    pairs = list(combinations(sorted(set(names.tolist())), 2))

    def machine(x, names, a, b):
        rows = (names == a) | (names == b)
        return fit_machine(x[rows].astype(np.float32), np.where(names[rows] == a, 1.0, -1.0))

    if spark is None or len(pairs) <= LOCAL_PAIRS:
        return {(a, b): machine(x, names, a, b) for a, b in pairs}
    sent = spark.sparkContext.broadcast((x.astype("<f2"), names, pairs))  # the bounded sample of each language

    def work(batches):
        x, names, pairs = sent.value
        for batch in batches:
            ids = batch.column("id")
            yield pa.RecordBatch.from_arrays([ids, pa.array([machine(x, names, *pairs[i]).tobytes() for i in ids.to_pylist()], pa.binary())], ["id", "w"])

    got = spark.range(0, len(pairs), 1, min(len(pairs), 200)).mapInArrow(work, "id long, w binary").collect()
    return {pairs[r.id]: np.frombuffer(bytes(r.w)) for r in got}


def vote(machines: dict[tuple[str, str], np.ndarray], names: list[str], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The name with most votes (then the widest margin, then the first) and its mean probability."""
    if len(names) == 1:
        return np.zeros(len(x), int), np.ones(len(x))
    votes, sure = np.zeros((len(x), len(names))), np.zeros((len(x), len(names)))
    for (a, b), w in machines.items():
        p = 1 / (1 + np.exp(-4 * np.clip(x @ w[:-1] + w[-1], -20, 20)))
        i, j = names.index(a), names.index(b)
        votes[:, i] += p > 0.5
        votes[:, j] += p <= 0.5
        sure[:, i] += p
        sure[:, j] += 1 - p
    best = (votes * 10 * len(names) + sure).argmax(1)
    return best, sure[np.arange(len(x)), best] / (len(names) - 1)


class Model:
    """Families, then the languages of each."""

    def __init__(self, x: np.ndarray, langs: np.ndarray, spark: SparkSession | None = None):
        kinds = np.array([family(v) for v in langs.tolist()], dtype=object)
        self.families = sorted(set(kinds.tolist()))
        self.top = fit_pairs(x, kinds, spark)
        self.inside = {}
        for f in self.families:
            rows = kinds == f
            self.inside[f] = (sorted(set(langs[rows].tolist())), fit_pairs(x[rows], langs[rows], spark))

        #: Rows of each language that the machines are fitted on.
        self.sizes = Counter(langs.tolist())
        self.means, self.bounds = {}, {}
        for lang in set(langs.tolist()):
            own = x[langs == lang]
            mean = own.mean(0)
            self.means[lang] = mean / max(np.linalg.norm(mean), 1e-9)
            self.bounds[lang] = NEAR_SHARE * np.quantile(own @ self.means[lang], NEAR_QUANTILE)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language and score of each text, and whether it is of a known language."""
        import regex

        letter = regex.compile(r"\p{L}")
        has = np.array([t is not None and letter.search(t) is not None for t in texts], bool)
        x = features(texts)
        kind, sure = vote(self.top, self.families, x) if self.families else (np.zeros(len(x), int), np.zeros(len(x)))
        langs, score = np.full(len(texts), "und", dtype=object), np.zeros(len(texts))
        for i, f in enumerate(self.families):
            rows = np.flatnonzero((kind == i) & has)
            if len(rows):
                names, machines = self.inside[f]
                best, p = vote(machines, names, x[rows])
                langs[rows] = np.array(names, dtype=object)[best]
                score[rows] = np.clip(sure[rows] * p, 0, 1)
        near = np.zeros(len(texts), bool)
        for lang in set(langs.tolist()) & set(self.means):
            rows = np.flatnonzero(langs == lang)
            near[rows] = x[rows] @ self.means[lang] >= self.bounds[lang]
        return langs.tolist(), score, near


def learnable(docs: DataFrame) -> DataFrame:
    """doc_id, text and lang of the labelled rows that may be learnt from."""
    rows = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    return rows.where("doc_id is not null and lang is not null and text is not null").where(~held_out(F.col("doc_id")))


def fit(docs: DataFrame) -> Model:
    """The start of :func:`learn`: machines of at most ``PER_LANGUAGE`` distinct labelled rows of each language.

    They are those with the smallest hashes of id and text; only they, as vectors, reach the driver."""
    rows = learnable(docs).withColumn("k", F.xxhash64("doc_id"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row for each language
    if not counts:
        return Model(np.zeros((0, FEATURES), np.float32), np.array([], dtype=object))
    spark = docs.sparkSession

    def below(most: dict[str, tuple[int, int]]) -> DataFrame:
        """Distinct (id, text) of a language up to a key of hashes; all keys are one row, so nothing is dealt by language."""
        one = spark.createDataFrame([(most,)], "most map<string,struct<k:long,t:long>>")
        bound = F.col("most")[F.col("lang")]
        near = rows.crossJoin(F.broadcast(one)).where(F.col("k") <= bound["k"])
        near = near.withColumn("t", F.xxhash64("text")).where((F.col("k") < bound["k"]) | (F.col("t") <= bound["t"]))
        return near.groupBy("lang", "k", "t").agg(F.first("text").alias("text"))  # repeated rows meet before they move

    # hashes are even, so a language's smallest lie below a bound that its count gives; few ids on many rows need a wider one
    share = {lang: 4 * PER_LANGUAGE / n for lang, n in counts.items()}
    while True:
        most = {lang: (min(int((x + 1e-6) * 2**64) - 2**63, 2**63 - 1), 2**63 - 1) for lang, x in share.items()}
        keys = materialize(below(most).select("lang", "k", "t"), "keys")
        got = {r["lang"]: r["count"] for r in keys.groupBy("lang").count().collect()}
        few = [lang for lang, x in share.items() if x < 1 and got.get(lang, 0) < PER_LANGUAGE]
        if not few:
            break
        discard(keys)
        share |= {lang: 64 * share[lang] for lang in few}
    first = keys.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("k", "t"))).where(F.col("r") <= PER_LANGUAGE)
    last = first.groupBy("lang").agg(F.max(F.struct("k", "t")).alias("last")).collect()

    def work(batches):
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES, BATCH_ROWS):
                x = features(part.column("text").to_pylist())
                data = pa.array([v.tobytes() for v in x.astype("<f2")], pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("lang", "k", "t")), data], ["lang", "k", "t", "x"])

    chosen = below({r["lang"]: tuple(r["last"]) for r in last}).select("lang", "k", "t", "text")
    sample = sorted((r.lang, r.k, r.t, bytes(r.x)) for r in chosen.mapInArrow(work, "lang string, k long, t long, x binary").collect())
    discard(keys)
    x = np.frombuffer(b"".join(row[-1] for row in sample), "<f2").reshape(len(sample), FEATURES).astype(np.float32)
    return Model(x, np.array([row[0] for row in sample], dtype=object), spark)


def _packed(counts: np.ndarray) -> bytes:
    """Counts in as few bytes as all of them fit."""
    top = int(counts.max(initial=0))
    return counts.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4").tobytes()


def _vectors(batches: Iterator[pa.RecordBatch], places: dict[str, int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of languages and vectors of rows (lang, x: packed counts), ``ADDED_ROWS`` at a time."""
    for whole in batches:
        for a in range(0, whole.num_rows, ADDED_ROWS):
            part = whole.slice(a, ADDED_ROWS)
            raw = part.column("x").to_pylist()
            x = np.sqrt(np.stack([np.frombuffer(r, f"<u{len(r) // FEATURES}") for r in raw]).astype(np.float64))
            norm = np.linalg.norm(x, axis=1, keepdims=True)
            yield np.array([places[v] for v in part.column("lang").to_pylist()]), x / np.where(norm > 0, norm, 1)


def _sums(rows: DataFrame, places: dict[str, int], add: Callable[[np.ndarray, np.ndarray, np.ndarray], None], shape: tuple[int, int]) -> np.ndarray:
    """The sum over all rows of what ``add(out, lang, x)`` adds to ``out``: tasks sum their rows, then each line of ``out`` is summed."""

    def work(batches):
        out = np.zeros(shape)
        for lang, x in _vectors(batches, places):
            add(out, lang, x)
        some = np.flatnonzero(out.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([out[i].tobytes() for i in some], pa.binary())], ["i", "s"])

    def total(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, s in zip(batch.column("i").to_pylist(), batch.column("s").to_pylist()):
                sums[i] = sums.get(i, 0) + np.frombuffer(s)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["i", "s"])

    out = np.zeros(shape)
    # every line meets in one task: a row for each task that read rows
    for r in rows.select("lang", "x").mapInArrow(work, "i int, s binary").repartition("i").mapInArrow(total, "i int, s binary").collect():
        out[r.i] = np.frombuffer(bytes(r.s))
    return out


def learn(docs: DataFrame) -> Model:
    """Machines, mean vectors and bounds of all labelled rows that may be learnt from."""
    model = fit(docs)
    counts = {r["lang"]: r["count"] for r in learnable(docs).groupBy("lang").count().collect()}  # a row for each language
    if counts == dict(model.sizes):
        return model

    def work(batches):
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES, BATCH_ROWS):
                data = pa.array([_packed(c) for c in counted(part.column("text").to_pylist())], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("lang"), data], ["lang", "x"])

    rows = materialize(learnable(docs).select("lang", "text").mapInArrow(work, "lang string, x binary"), "counts")
    langs = sorted(counts)
    places, n = {v: i for i, v in enumerate(langs)}, np.array([counts[v] for v in langs], np.float64)
    sets = [(model.top, family)] + [(model.inside[f][1], lambda v: v) for f in model.families]
    each = [(machines, pair) for machines, _ in sets for pair in machines]
    # whether a machine calls a language's rows 1 or -1, and what a row weighs: both sides weigh one half
    side = np.array([[1.0 if name(v) == a else -1.0 if name(v) == b else 0.0 for machines, name in sets for a, b in machines] for v in langs]).reshape(len(langs), len(each))
    weight = np.zeros_like(side)
    for sign in (1, -1):
        weight += np.where(side == sign, 0.5 / np.maximum(1, (n[:, None] * (side == sign)).sum(0)), 0)

    if each:
        w = v = np.array([machines[pair] for machines, pair in each])
        rate, decay = 1 / (4 + 1e-4), 1e-4
        for t in range(PASSES):

            def slopes(out, lang, x, v=v):
                y = side[lang]
                push = weight[lang] * y * np.maximum(0, 1 - y * (x @ v[:, :-1].T + v[:, -1]))
                out[:, :-1] += push.T @ x
                out[:, -1] += push.sum(0)

            new = v - rate * (decay * v - 2 * _sums(rows, places, slopes, v.shape))
            v = new + t / (t + 3) * (new - w)
            w = new
        # the order of sums shows in later decimals only
        for (machines, pair), row in zip(each, np.round(w, DECIMALS)):
            machines[pair] = row

    def means(out, lang, x):
        np.add.at(out, lang, x)

    mean = np.round(_sums(rows, places, means, (len(langs), FEATURES)) / n[:, None], DECIMALS)
    mean /= np.maximum(np.linalg.norm(mean, axis=1, keepdims=True), 1e-9)

    def cosines(out, lang, x):
        near = np.einsum("ij,ij->i", x, mean[lang])
        np.add.at(out, (lang, np.clip((near * COSINES).astype(int), 0, COSINES - 1)), 1)

    met = np.cumsum(_sums(rows, places, cosines, (len(langs), COSINES)), axis=1)
    for i, lang in enumerate(langs):
        model.means[lang] = mean[i]
        model.bounds[lang] = NEAR_SHARE * np.searchsorted(met[i], NEAR_QUANTILE * (n[i] - 1), side="right") / COSINES
    discard(rows)
    return model


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` plus ``lang_pred``, ``score`` and ``known``; docs may hold any other columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # languages x features numbers
    names = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score", "known")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in names) + ", lang_pred string, score double, known boolean"

    def work(batches):
        for batch in batches:
            for part in slices(batch, text, BATCH_BYTES, BATCH_ROWS):
                langs, score, known = sent.value.predict(part.column(text).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs, pa.string()), pa.array(score), pa.array(known)], [*part.schema.names, "lang_pred", "score", "known"])

    return docs.select(*[F.col(f"`{f.name}`") for f in names]).mapInArrow(work, schema)


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: held_out, lang_pred and score."""
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return predict(rows, learn(docs)).select("doc_id", "held_out", "lang_pred", "score")


def keep_known(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text is of a known language; all if none can be learnt."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("__row"), F.col("text").alias("__text"))
    model = learn(docs)
    return predict(rows, model, "__text").where("known").select("__row.*") if model.families else docs
