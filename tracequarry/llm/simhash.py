"""SimHash near-duplicates through Golay-code fuzzy hashing.

Every 23-bit word lies within 3 bits of exactly one word of the perfect binary
Golay code, so decoding hashes a segment to one of 4096 indices.  A fingerprint's
64 bits are dealt to segments of 22, 21 and 21.  Of at most 3 differing bits, two
segments hold at most one each: for each pair of segments a fingerprint stores the
indices of both, and looks up, in each, the indices of all words within one bit
(one, or up to six).  Each linked pair meets in a lookup, so nothing is missed;
an exact bit count in the join drops the rest.

Only distinct fingerprints are stored and looked up, and a fingerprint has a
bounded number of others within 3 bits, so groups of copies don't multiply rows.

Null text counts as empty; a text without words has fingerprint 0 and links like
any other.  Repeated rows share a fingerprint.  A null id never becomes a
component's id unless all its documents lack one.  An empty table gives no rows;
other columns are not read by :func:`cluster` and kept by :func:`keep_first`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracequarry.lineage import materialize
from tracequarry.llm.bpe import slices
from tracequarry.llm.components import components, with_least, with_values

SHINGLE, SEED, MAX_BITS = 3, 42, 3
#: Bits of a fingerprint's segments and the pairs of segments that are joined on.
SEGMENTS = (22, 21, 21)
PAIRS = ((0, 1), (0, 2), (1, 2))
#: Generator polynomial of the binary Golay code (23, 12).
GENERATOR = 0b101011100011

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Bit i is set if bit i is set in over half of the shingles' hashes."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()  # splits at ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = ends - ends[0] + 0
    starts[1:], starts[0] = ends[:-1], 0
    if len(words) >= size:
        starts, ends = starts[: len(words) - size + 1], ends[size - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts.tolist(), (ends - 1).tolist())]
    ones = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[a : a + (1 << 16)], np.uint64)
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and ``fp``, the fingerprint as a signed long."""

    def work(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                fp = np.array([fingerprint(t) for t in part.column("text").to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, fp long")


class Golay:
    """Nearest codeword of 23-bit words, by syndrome."""

    def __init__(self):
        def remainder(w: np.ndarray) -> np.ndarray:
            w = w.copy()
            for bit in range(22, 10, -1):
                w ^= np.where((w >> bit) & 1, GENERATOR << (bit - 11), 0)
            return w

        self.low, self.high = remainder(np.arange(1 << 12)), remainder(np.arange(1 << 11) << 12)
        bits = 1 << np.arange(23)
        errors = [np.zeros(1, np.int64), bits]
        i, j = np.triu_indices(23, 1)
        errors.append(bits[i] | bits[j])
        errors.append(np.array([bits[x] | bits[y] | bits[z] for x in range(23) for y in range(x + 1, 23) for z in range(y + 1, 23)]))
        errors = np.concatenate(errors)
        self.error = np.zeros(1 << 11, np.int64)
        self.error[self.syndrome(errors)] = errors

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        return self.low[words & 0xFFF] ^ self.high[words >> 12]

    def index(self, words: np.ndarray) -> np.ndarray:
        """The 12 message bits of each word's codeword."""
        return (words ^ self.error[self.syndrome(words)]) >> 11

    def near(self, words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct indices of all words within one bit: (position of the word, index)."""
        around = words[:, None] ^ np.concatenate([[0], 1 << np.arange(width)])[None, :]
        found = np.sort(self.index(around), axis=1)
        new = np.ones(found.shape, bool)
        new[:, 1:] = found[:, 1:] != found[:, :-1]
        at, _ = np.nonzero(new)
        return at, found[new]


_golay: list[Golay] = []


def keys(fps: np.ndarray, probe: bool) -> tuple[np.ndarray, np.ndarray]:
    """Join keys of fingerprints: (key, fingerprint), one per pair of segments, or all nearby ones."""
    if not _golay:
        _golay.append(Golay())
    code, shift, parts = _golay[0], 0, []
    for width in SEGMENTS:
        parts.append(((fps.view(np.uint64) >> np.uint64(shift)).astype(np.int64)) & ((1 << width) - 1))
        shift += width
    out = []
    near = [code.near(p, w) for p, w in zip(parts, SEGMENTS)] if probe else None
    for k, (i, j) in enumerate(PAIRS):
        if not probe:
            out.append((k << 24 | code.index(parts[i]) << 12 | code.index(parts[j]), fps))
            continue
        (at_i, index_i), (at_j, index_j) = near[i], near[j]
        n_j = np.bincount(at_j, minlength=len(fps))
        first_j = np.cumsum(n_j) - n_j
        times = n_j[at_i]
        left = np.repeat(np.arange(len(at_i)), times)
        right = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times) + first_j[at_i[left]]
        out.append((k << 24 | index_i[left] << 12 | index_j[right], fps[at_i[left]]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _keyed(distinct: DataFrame, probe: bool, name: str) -> DataFrame:
    def work(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                key, fp = keys(batch.column("fp").slice(a, 4096).to_numpy(zero_copy_only=False), probe)
                yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int32)), pa.array(fp)], ["key", name])

    return distinct.select("fp").mapInArrow(work, f"key int, {name} long")


def links(distinct: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints ``fp`` that differ in at most MAX_BITS bits."""
    stored, looked = _keyed(distinct, False, "a"), _keyed(distinct, True, "b")
    close = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS)
    return looked.join(stored, (looked.key == stored.key) & close).select("a", "b").distinct()


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _classes(fps: DataFrame) -> DataFrame:
    """fp, the component's smallest doc_id and the number of rows, for each distinct fingerprint of (doc_id, fp)."""
    distinct = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("__n")), "fingerprints")
    roots = components(links(distinct)).withColumnRenamed("node", "fp")
    roots = materialize(roots.join(distinct.drop("__n"), "fp"), "roots")
    linked = with_least(roots, "root", "first", "component_id", roots.count()).select("fp", "component_id", F.lit(True).alias("linked"))
    return distinct.join(linked, "fp", "left").select("fp", "__n", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("first")).alias("component_id"))


def cluster(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint and the smallest doc_id of its component."""
    fps = materialize(fingerprints(docs), "simhash")
    return with_values(fps, _classes(fps), "fp", fps.count()).select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns as they are, but one row of each component only.

    It is a row with the component's smallest id, with a null id only if all its documents lack one. Components are told
    apart by their root fingerprint, so unrelated rows with equal or null ids don't touch each other."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(F.col("doc_id").alias("__id"), row.alias("__row"), F.col("text").alias("__text"))
    names = rows.schema

    def work(batches):
        for batch in batches:
            for part in slices(batch, "__text"):
                fp = np.array([fingerprint(t) for t in part.column("__text").to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(fp.view(np.int64))], ["__id", "__row", "fp"])

    kind = f"`__id` {names['__id'].dataType.simpleString()}, `__row` {names['__row'].dataType.simpleString()}, fp long"
    marked = materialize(rows.mapInArrow(work, kind).withColumn("__key", F.monotonically_increasing_id()), "simhash")
    # of each fingerprint, then of each component, the row that stays. Texts are shuffled once, by the row's key
    order = F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), "fp", "__key")
    distinct = materialize(marked.groupBy("fp").agg(F.min(order).alias("first")), "fingerprints")
    roots = components(links(distinct)).withColumnRenamed("node", "fp")
    least = distinct.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    return marked.join(least.select("first.__key"), "__key").select("__row.*")
