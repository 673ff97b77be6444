"""Alignment of two tokenizers over the same bytes, with corpus-wide counts of id pairs.

A text with a space in front is encoded by a byte-level model (A) and by a sentence
model with byte fallback (B).  Where tokens of both end at one byte, a group ends and
the two tokens are linked.  A link's ids are packed into one 64-bit key.

Neither model joins anything over a single space between two other characters, so
texts are cut there and distinct chunks are aligned once for a batch and remembered by
a worker.  One pass writes each text's distinct keys and, beside them, every task's
partial counts (``np.unique``).  Partial counts are range-partitioned by key, sorted and
run-length summed; the sorted shards become one file that workers map, and each text's
keys are found in it by binary search.

Tokens that end together are suffixes of one another, so the vocabularies alone bound
the number of different keys (:func:`most_pairs`, some 320,000 for the public ones):
what is mapped never grows with the texts beyond that.

Null and empty texts, and texts that a model doesn't give back byte for byte, have no
tokens and no groups.  Extra columns are not read.  No input row is dropped: repeated
rows and null ids give repeated rows, and repeated texts count as often as they stand
there; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracequarry.lineage import discard, materialize, scratch
from tracequarry.llm import mapped
from tracequarry.llm.bpe import _BLANK, _ODD, _gather, byte_alphabet, slices

#: Bits of a key that hold B's id.
B_BITS = 32
#: Chunks whose alignment a worker remembers, and those that are aligned in one call.
REMEMBERED, TOGETHER = 200_000, 1024
#: Characters of text that are aligned at once, and different keys that a task holds before it sums them.
BATCH_CHARS, HELD = 2_000_000, 1_000_000
#: Ranges of keys, each one shard of the counts.
SHARDS = 16


def pack(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.int64) << B_BITS | b.astype(np.int64)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their counts."""
    keys, at = np.unique(keys, return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, at, counts)
    return keys, total


def a_bytes(model_json: str) -> list[bytes]:
    """Bytes of each id of the byte-level model."""
    back = {c: b for b, c in enumerate(byte_alphabet())}
    vocab = json.loads(model_json)["model"]["vocab"]
    table = [b""] * (max(vocab.values()) + 1)
    for t, i in vocab.items():
        table[i] = bytes(back[c] for c in t) if all(c in back for c in t) else t.encode()
    return table


def b_bytes(model: bytes) -> list[bytes]:
    """Bytes of each id of the sentence model."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    return [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]


def most_pairs(a: list[bytes], b: list[bytes]) -> int:
    """No more different pairs of ids can end together: the shorter token is a suffix of the longer one."""
    def ends(tokens: list[bytes]) -> dict[bytes, int]:
        out: dict[bytes, int] = {}
        for t in tokens:
            out[t] = out.get(t, 0) + 1
        return out

    of_a, of_b = ends(a), ends(b)
    longer = sum(of_b.get(t[k:], 0) for t in a for k in range(len(t)))
    return longer + sum(of_a.get(t[k:], 0) for t in b for k in range(1, len(t)))


class Aligner:
    """Aligns Arrow string arrays; one lives in each worker."""

    _made: dict[str, Aligner] = {}

    @classmethod
    def of(cls, model_a: str, model_b: bytes) -> Aligner:
        key = hashlib.sha256(model_a.encode() + model_b).hexdigest()
        if key not in cls._made:
            cls._made = {key: cls(model_a, model_b)}
        return cls._made[key]

    def __init__(self, model_a: str, model_b: bytes):
        import os

        import regex

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(model_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        tables = [a_bytes(model_a), b_bytes(model_b)]
        if any(" " in self.b.id_to_piece(i).lstrip("▁").replace("▁", " ") for i in range(len(tables[1]))):
            raise ValueError("pieces of the sentence model reach over a space")
        self.flat = [np.frombuffer(b"".join(t), np.uint8) for t in tables]
        self.size = [np.array([len(x) for x in t], np.int64) for t in tables]
        self.at = [np.cumsum(s) - s for s in self.size]
        # an id's digits with each separator behind them, for writing groups
        most = max(map(len, tables))
        digits = [f"{i}{mark}".encode() for mark in ",|;" for i in range(most)]
        self.most, self.digits = most, np.frombuffer(b"".join(digits), np.uint8)
        self.digits_n = np.array([len(d) for d in digits], np.int64)
        self.digits_at = np.cumsum(self.digits_n) - self.digits_n
        solid = r"[^\s\x0b\x1c-\x1f\x85​᠎﻿\p{Z}]"
        self.cut = regex.compile(rf"(?<={solid}) (?={solid})")
        self.memo = self._align([])

    def _ids(self, text: str) -> list[np.ndarray]:
        """Ids of both models; text begins with a space."""
        first = self.a.encode(text, add_special_tokens=False).ids
        return [np.array(first, np.int64), np.array(self.b.encode(text[1:], num_threads=1), np.int64)]

    def _exact(self, ids: list[np.ndarray], raw: np.ndarray) -> bool:
        return all(np.array_equal(_gather(self.flat[k], self.at[k], self.size[k], ids[k]), raw) for k in (0, 1))

    def _align(self, chunks: list[str]) -> pa.Table:
        """Each chunk with a space in front: whether both models give back its bytes, its tokens and its groups.

        Many chunks go through the models as one text (halved while it isn't given back); those with white space at an
        end go alone and stand behind the others."""
        alone = pc.match_substring_regex(pa.array(chunks, pa.large_string()), f"^[{_BLANK}]|[{_BLANK}]$|▁").to_pylist()
        joined, apart = [c for c, x in zip(chunks, alone) if not x], [c for c, x in zip(chunks, alone) if x]
        parts = [self._aligned(joined[a : a + TOGETHER]) for a in range(0, len(joined), TOGETHER)] + [self._aligned([c]) for c in apart]
        empty = self._rows([], np.empty(0, bool), *[np.empty(0, np.int64)] * 2, [np.empty(0, np.int64)] * 2, np.empty(0, np.int64))
        return pa.concat_tables([empty, *parts])

    def _aligned(self, chunks: list[str]) -> pa.Table:
        text = "".join([" " + c for c in chunks])
        raw = np.frombuffer(text.encode(), np.uint8)
        ids = self._ids(text)
        if not self._exact(ids, raw):
            if len(chunks) > 1:
                half = len(chunks) // 2
                return pa.concat_tables([self._aligned(chunks[:half]), self._aligned(chunks[half:])])
            none = np.zeros(1, np.int64)
            return self._rows(chunks, np.zeros(1, bool), none, none, [np.empty(0, np.int64)] * 2, none)
        ends = [np.cumsum(self.size[k][ids[k]]) for k in (0, 1)]
        edges = np.cumsum([len(c.encode()) + 1 for c in chunks])
        tokens = [np.diff(np.searchsorted(e, edges, side="right"), prepend=0) for e in ends]
        shared, at_a, at_b = np.intersect1d(*ends, assume_unique=True, return_indices=True)
        groups = np.diff(np.searchsorted(shared, edges, side="right"), prepend=0)
        return self._rows(chunks, np.ones(len(chunks), bool), *tokens, [at_a, at_b], groups, ids)

    def _rows(self, chunks, good, n_a, n_b, at, groups, ids=None) -> pa.Table:
        """Chunks as rows; ``at`` has the places of the linked tokens, ``groups`` how many each chunk has."""
        if ids is None:
            keys, text, per_group = np.empty(0, np.int64), np.empty(0, np.uint8), np.empty(0, np.int64)
        else:
            at_a, at_b = at
            keys = pack(ids[0][at_a], ids[1][at_b])
            of_a, of_b = np.searchsorted(at_a, np.arange(len(ids[0]))), np.searchsorted(at_b, np.arange(len(ids[1])))
            last_a, last_b = np.zeros(len(ids[0]), np.int64), np.zeros(len(ids[1]), np.int64)
            last_a[at_a], last_b[at_b] = 1, 2
            coded = np.empty(len(of_a) + len(of_b), np.int64)
            before_b, upto_a = np.concatenate([[0], at_b + 1]), at_a + 1  # tokens of B before a group, of A up to its end
            coded[np.arange(len(of_a)) + before_b[of_a]] = last_a * self.most + ids[0]
            coded[np.arange(len(of_b)) + upto_a[of_b]] = last_b * self.most + ids[1]
            text = _gather(self.digits, self.digits_at, self.digits_n, coded)
            per_group = np.diff(np.cumsum(self.digits_n[coded])[at_a + at_b + 1], prepend=0)
        cuts = np.concatenate([[0], np.cumsum(groups)])
        marks = np.concatenate([[0], np.cumsum(per_group)])[cuts]
        shown = pa.Array.from_buffers(pa.large_binary(), len(groups), [None, pa.py_buffer(marks.astype(np.int64)), pa.py_buffer(text)])
        linked = pa.LargeListArray.from_arrays(pa.array(cuts), pa.array(keys))
        return pa.table({"word": pa.array(chunks, pa.large_string()), "good": good, "n_a": n_a, "n_b": n_b, "keys": linked, "shown": shown, "hits": np.ones(len(groups), np.int64)})

    def _known(self, words: pa.Array) -> pa.Table:
        """Rows of distinct chunks, from memory or new; when too many are remembered, those met most often stay."""
        at = pc.fill_null(pc.index_in(words, value_set=self.memo.column("word").combine_chunks()), -1).to_numpy(zero_copy_only=False)
        fresh = words.filter(pa.array(at < 0))
        new = self._align(fresh.to_pylist())
        hits = self.memo.column("hits").to_numpy().copy()
        hits[at[at >= 0]] += 1
        old = self.memo.set_column(6, "hits", pa.array(hits))
        both = pa.concat_tables([old, new]).combine_chunks()
        where = at.astype(np.int64)
        where[at < 0] = len(old) + pc.index_in(fresh, value_set=new.column("word").combine_chunks()).to_numpy(zero_copy_only=False)
        out = both.take(pa.array(where))
        if len(both) > REMEMBERED:
            hits = np.concatenate([hits, np.ones(len(new), np.int64)])
            short = np.flatnonzero(pc.less(pc.binary_length(both.column("word")), 64).to_numpy())
            keep = np.sort(short[np.argsort(-hits[short], kind="stable")[: REMEMBERED // 2]])
            both = both.take(pa.array(keep)).set_column(6, "hits", pa.array(hits[keep] // 2))
        self.memo = both
        return out

    def _chunks(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Chunks of the texts and how many each has; none of an empty text."""
        odd = pc.match_substring_regex(texts, _ODD)
        parts = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        parts = parts.combine_chunks() if isinstance(parts, pa.ChunkedArray) else parts
        sizes = np.diff(parts.offsets.to_numpy()).astype(np.int64)
        chunks = parts.flatten().cast(pa.large_string())
        if pc.any(odd).as_py():  # other white space: cut by the library of patterns, put in the place of the one empty chunk
            rows = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
            cut = [self.cut.split(t) for t in texts.filter(odd).to_pylist()]
            starts = np.cumsum(sizes) - sizes
            sizes[rows], was = [len(c) for c in cut], sizes[rows]
            starts[rows] = len(chunks) + np.cumsum(sizes[rows]) - sizes[rows]
            assert (was == 1).all()
            chunks = pa.concat_arrays([chunks, pa.array([c for some in cut for c in some], pa.large_string())])
            chunks = chunks.take(pa.array(_gather(np.arange(len(chunks)), starts, sizes, np.arange(len(sizes)))))
        return chunks, sizes

    def align(self, texts: pa.Array) -> Aligned:
        texts = pc.fill_null(texts, "")
        full = pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        chunks, sizes = self._chunks(texts)
        coded = chunks.dictionary_encode()
        rows = self._known(coded.dictionary)
        codes = coded.indices.to_numpy().astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        good = rows.column("good").to_numpy()[codes]
        good = full & (np.add.reduceat(np.concatenate([~good, [False]]).astype(np.int64), bounds[:-1]) == 0) if len(sizes) else full
        kept = np.repeat(good, sizes)
        codes, sizes = codes[kept], np.where(good, sizes, 0)
        # a chunk that isn't given back might be made good by its neighbours: such texts are aligned whole
        doubtful = np.flatnonzero(full & ~good)
        if len(doubtful):
            whole = [self._aligned([t]) for t in texts.take(pa.array(doubtful)).to_pylist()]
            extra = pa.concat_tables(whole)
            taken = extra.column("good").to_numpy()
            rows = pa.concat_tables([rows, extra])
            sizes[doubtful] = taken
            order = np.cumsum(sizes) - sizes
            codes = np.insert(codes, order[doubtful[taken]] - np.arange(int(taken.sum())), len(rows) - len(extra) + np.flatnonzero(taken))
        return Aligned(rows.combine_chunks(), codes, np.concatenate([[0], np.cumsum(sizes)]))


class Aligned:
    """Distinct chunks (``rows``), the chunks of all texts by row number, and where each text's begin."""

    def __init__(self, rows: pa.Table, codes: np.ndarray, bounds: np.ndarray):
        self.rows, self.codes, self.bounds = rows, codes, bounds
        keys = rows.column("keys").combine_chunks()
        cuts = keys.offsets.to_numpy()
        self.keys = keys.flatten().to_numpy()
        self.groups = np.diff(cuts)
        self.starts = cuts[:-1] - (cuts[0] if len(cuts) else 0)

    def sums(self, name: str) -> np.ndarray:
        values = self.groups if name == "groups" else self.rows.column(name).to_numpy()
        return np.diff(np.concatenate([[0], np.cumsum(values[self.codes])])[self.bounds])

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys of all texts together and their numbers."""
        times = np.bincount(self.codes, minlength=len(self.rows))
        return summed(self.keys, np.repeat(times, self.groups))

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys of each text's links one after another, and where each text's begin."""
        keys = _gather(self.keys, self.starts, self.groups, self.codes)
        return keys, np.concatenate([[0], np.cumsum(self.groups[self.codes])])[self.bounds]

    def shown(self) -> list[bytes | memoryview]:
        """Each text's groups, written down."""
        out = self.rows.column("shown").combine_chunks().take(pa.array(self.codes))
        cuts = np.frombuffer(out.buffers()[1], np.int64)[out.offset : out.offset + len(out) + 1][self.bounds].tolist()
        data = memoryview(out.buffers()[2] or b"")
        return [data[a : max(a, b - 1)] for a, b in zip(cuts, cuts[1:])]


def _fields(docs: DataFrame, keep: tuple[str, ...]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)


def _scanned(docs: DataFrame, model_a: str, model_b: bytes, keep: tuple[str, ...], text: str) -> DataFrame:
    """Rows of kind 0, one for each text, and of kind 1, a task's partial counts.  Either has ``__keys`` and ``__times``."""
    shared = docs.sparkSession.sparkContext.broadcast((model_a, model_b))  # the vocabulary files' size
    source = docs.select(*keep, F.col(text).alias("__text"))
    fields = [*[(f.name, f.dataType) for f in docs.select(*keep).schema]]
    names = [*[n for n, _ in fields], "n_a", "n_b", "n_groups", "groups_sha256", "__keys", "__times", "__kind"]
    lists = lambda flat, cuts, kind: pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(flat, kind))

    def tell(held: list) -> pa.RecordBatch:
        keys, counts = summed(np.concatenate([k for k, _ in held]), np.concatenate([n for _, n in held]))
        cuts = np.append(np.arange(0, len(keys), 8192), len(keys))
        n = len(cuts) - 1
        none = [pa.nulls(n, kind) for kind in kinds]
        return pa.RecordBatch.from_arrays([*none, lists(keys, cuts, pa.int64()), lists(counts, cuts, pa.int64()), pa.array(np.ones(n, np.int32))], names)

    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [*[to_arrow_type(k) for _, k in fields], pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner.of(*shared.value)
        held: list = []
        for batch in batches:
            for part in slices(batch, "__text", BATCH_CHARS):
                found = aligner.align(part.column("__text"))
                held.append(found.counts())
                if sum(len(k) for k, _ in held) > HELD:
                    held = [summed(np.concatenate([k for k, _ in held]), np.concatenate([n for _, n in held]))]
                keys, bounds = found.links()
                each = [np.unique(keys[a:b], return_counts=True) for a, b in zip(bounds.tolist(), bounds[1:].tolist())]
                cuts = np.concatenate([[0], np.cumsum([len(k) for k, _ in each])])
                hashes = [hashlib.sha256(x).hexdigest() if len(x) else "" for x in found.shown()]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[c.cast(k) for c, k in zip(part.columns[:-1], kinds)], pa.array(found.sums("n_a")), pa.array(found.sums("n_b")), pa.array(found.sums("groups")), pa.array(hashes, pa.string()),
                        lists(np.concatenate([np.empty(0, np.int64), *[k for k, _ in each]]), cuts, pa.int64()), lists(np.concatenate([np.empty(0, np.int64), *[n for _, n in each]]), cuts, pa.int64()),
                        pa.array(np.zeros(len(each), np.int32)),
                    ],
                    names,
                )
        if held:
            yield tell(held)

    schema = ", ".join([*([_fields(docs, keep)] if keep else []), "n_a long, n_b long, n_groups long, groups_sha256 string, __keys array<long>, __times array<long>, __kind int"])
    return source.mapInArrow(work, schema)


def pair_counts(partial: DataFrame, shards: int = SHARDS) -> DataFrame:
    """key, n and shard from partial counts (``__keys``, ``__times``): keys ascend over the shards and inside each.

    A key's rows, one for each task that met it, are in one range and are summed as runs while they stream by."""
    each = partial.select(F.explode(F.arrays_zip("__keys", "__times")).alias("p")).select(F.col("p.__keys").alias("key"), F.col("p.__times").alias("n"))
    dealt = each.repartitionByRange(shards, "key").sortWithinPartitions("key")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, open_n = None, 0
        for batch in batches:
            keys, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(keys):
                continue
            first = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
            keys, n = keys[first], np.add.reduceat(n, first)
            if open_key == keys[0]:
                n[0] += open_n
            elif open_key is not None:
                keys, n = np.insert(keys, 0, open_key), np.insert(n, 0, open_n)
            open_key, open_n = keys[-1], n[-1]
            if len(keys) > 1:
                yield pa.RecordBatch.from_arrays([pa.array(keys[:-1]), pa.array(n[:-1])], ["key", "n"])
        if open_key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([open_key], pa.int64()), pa.array([open_n], pa.int64())], ["key", "n"])

    return dealt.mapInArrow(runs, "key long, n long").withColumn("shard", F.spark_partition_id())


def count_table(counts: DataFrame) -> dict[str, np.ndarray]:
    """Sorted shards laid one after another: keys, counts, and whether a count is the highest of the key's id of B.

    Each shard is made where its keys are; the driver only strings together what :func:`most_pairs` bounds."""
    of_b = F.col("key").bitwiseAND((1 << B_BITS) - 1)
    top = counts.groupBy(of_b.alias("b")).agg(F.max("n").alias("top"))  # a row for each id of B
    told = counts.join(top, of_b == F.col("b")).select("shard", "key", "n", (F.col("n") == F.col("top")).alias("best"))

    def shard(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        raw = [table.column(c).to_numpy() for c in ("key", "n")]
        best = table.column("best").to_numpy(zero_copy_only=False).astype(np.uint8)
        return pa.table({"shard": [key[0].as_py()], "keys": [raw[0].tobytes()], "n": [raw[1].tobytes()], "best": [best.tobytes()]}, schema=pa.schema([("shard", pa.int32()), *[(c, pa.binary()) for c in ("keys", "n", "best")]]))

    rows = sorted(told.groupBy("shard").applyInArrow(shard, "shard int, keys binary, n binary, best binary").collect(), key=lambda r: r.shard)
    strung = lambda name, kind: np.frombuffer(b"".join(bytes(r[name]) for r in rows), kind)
    return {"keys": strung("keys", np.int64), "n": strung("n", np.int64), "best": strung("best", np.uint8)}


def align(docs: DataFrame, model_a: str, model_b: bytes, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of each text."""
    spark = docs.sparkSession
    path = scratch(spark, "links")
    scanned = _scanned(docs, model_a, model_b, keep, text)
    scanned.write.option("compression", "zstd").partitionBy("__kind").parquet(path)
    rows = spark.read.schema(scanned.schema).parquet(path)
    counts = materialize(pair_counts(rows.where("__kind = 1").select("__keys", "__times")), "pairs")
    name = mapped.ship(spark, "counts", count_table(counts))
    discard(counts)
    kinds = scanned.select(*keep).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = mapped.opened(mapped.fetched(name))
        for batch in batches:
            keys, times = batch.column("__keys"), batch.column("__times")
            cuts = keys.offsets.to_numpy().astype(np.int64)
            flat, times = keys.flatten().to_numpy(), times.flatten().to_numpy()
            at = np.searchsorted(table["keys"], flat)
            total = lambda x: pa.array(np.diff(np.concatenate([[0], np.cumsum(x)])[cuts - cuts[0]]).astype(np.int64))
            n_best, count_sum = total(times * table["best"][at]), total(times * table["n"][at])
            own = [batch.column(f.name) for f in kinds]
            some = [batch.column(c) for c in ("n_a", "n_b", "n_groups")]
            yield pa.RecordBatch.from_arrays([*own, *some, batch.column("n_groups"), n_best, count_sum, batch.column("groups_sha256")], [*[f.name for f in kinds], "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    schema = ", ".join([_fields(docs, keep), "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"])
    return rows.where("__kind = 0").drop("__kind").mapInArrow(work, schema)
