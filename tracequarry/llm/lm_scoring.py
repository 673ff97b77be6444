"""Language-model scoring by cross-entropy difference.

Two bigram models, of the target rows and of all rows, are interpolated down to
the same pooled unigram distribution and share one vocabulary, order, smoothing
and mass: background counts are scaled to the target's size, so that smoothing
weighs alike on both and a difference of losses comes from evidence.  A document's
score is its mean loss per token under the target less that under the background:
low is like the target.

Words and word pairs are counted by their 64-bit hashes: every one has counts of
its own, and what is kept grows with the corpus.  Texts are packed into chunks of
bounded size, longer texts cut into runs at white space; a chunk asks once for each of its distinct words and pairs, together
with its own counts of them.  What all chunks ask for is dealt out by ranges of
hashes (the more chunks, the more ranges), added up there and sent back, so no
task holds the vocabulary and a common word costs a number per chunk.  Target
rows are found by a join of ids alone, at every size.

Null and empty texts have no tokens and null losses and score.  Target ids that
repeat or don't exist don't matter; without target rows every score is 0.  Repeated
rows are counted and scored again; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracequarry.lineage import materialize
from tracequarry.llm.bpe import slices

#: Words that the pooled distribution is smoothed over; counts have no bound.
WORD_SLOTS = 1 << 18
#: Pseudo-counts of the pooled distribution in unigrams, and of unigrams in bigrams.
POOLED, BACKOFF = 1000.0, 8.0
#: Bytes of text of a chunk, and of the runs that longer texts are cut into.
CHUNK_BYTES, RUN_BYTES = 6_000_000, 1_000_000
#: Longer words are hashed one by one; tokens that are scored at once.
LONG_WORD, BLOCK = 4096, 100_000
#: Ranges of hashes, at least (a power of two), and chunks for which there is one more.
RANGES, CHUNKS_A_RANGE = 1024, 4

_LOWER = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))
_PRIME = np.uint64(0x100000001B3)
_BLANK = re.compile(rb"[ \t-\r]")


def _words(texts: list[str | None]) -> tuple[np.ndarray, ...]:
    """Bytes of all texts, which of them are in words, where words begin, and the text of each word."""
    raw = [(t or "").encode("utf-8", "replace").translate(_LOWER) + b" " for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    solid = data != 32
    begin = np.flatnonzero(solid & np.concatenate([[True], ~solid[:-1]])) if len(data) else np.empty(0, np.int64)
    return data, solid, begin, np.searchsorted(np.cumsum([len(x) for x in raw]), begin, side="right")


def _hashed(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    from xxhash import xxh64_intdigest

    data, solid, begin, text = _words(texts)
    if not len(begin):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    blank = np.flatnonzero(~solid)
    end = blank[np.searchsorted(blank, begin)]  # each text has a blank behind it
    long = np.flatnonzero(end - begin > LONG_WORD)
    for k in long.tolist():  # stands as its first byte below, and gets its hash afterwards
        solid[begin[k] + 1 : end[k]] = False
    at = np.flatnonzero(solid)
    first = np.searchsorted(at, begin)
    size = np.diff(first, append=len(at))
    place = np.arange(len(at)) - np.repeat(first, size)
    powers = np.full(place.max() + 1, _PRIME)
    powers[0] = 1
    with np.errstate(over="ignore"):
        powers = np.cumprod(powers, dtype=np.uint64)
        sums = np.add.reduceat((data[at].astype(np.uint64) + np.uint64(1)) * powers[place], first)
        sums = (sums ^ (sums >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    for k in long.tolist():
        sums[k] = xxh64_intdigest(data[begin[k] : end[k]].tobytes(), 1)
    return sums, text


def tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes (64 bits) of all texts, and the text of each word. Words end at ASCII white space.

    About ``RUN_BYTES`` are worked on at once, as it takes some 60 bytes for one of text."""
    size = np.cumsum([len(t or "") for t in texts])
    out, a = [(np.empty(0, np.uint64), np.empty(0, np.int64))], 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + RUN_BYTES, side="right")))
        hashes, text = _hashed(texts[a:b])
        out.append((hashes, text + a))
        a = b
    return tuple(np.concatenate(x) for x in zip(*out))


def grams(texts: list[str | None], lead: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct hashes of words and pairs; place of each token's word and of its pair with the token
    before it (those after a token only); the text of each token; whether a token stands before it; whether it counts.

    The first token of a text with ``lead`` is the last one of the run before, and counts there."""
    hashes, text = tokens(texts)
    after = np.zeros(len(hashes), bool)
    after[1:] = text[1:] == text[:-1]
    counts = after | ~lead[text]
    with np.errstate(over="ignore"):
        pair = (hashes[:-1] * np.uint64(0xD6E8FEB86659FD93)) ^ hashes[1:]
        pair = (pair ^ (pair >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    keys, at = np.unique(np.concatenate([hashes, pair[after[1:]]]), return_inverse=True)
    return keys, at[: len(hashes)], at[len(hashes) :], text, after, counts


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of one length, byte by byte of the numbers, compressed."""
    raw = b"".join(c.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns)
    return pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(data: bytes, rows: int, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(pa.decompress(data, decompressed_size=8 * rows * columns, codec="zstd"), np.uint8).reshape(columns, 8, rows)
    return [np.ascontiguousarray(c.T).view("<u8").ravel() for c in raw]


def _runs(part: pa.RecordBatch, key: int) -> list[pa.RecordBatch]:
    """A part of documents (doc_id, text) as runs (doc_id, text, lead, key).

    A text longer than ``RUN_BYTES`` is cut at white space; each run but the first begins with the last word of the
    one before, and all have the same key. Shorter texts have none."""
    data = part.column("text")[0].as_buffer() if part.num_rows == 1 and part.column("text")[0].is_valid else b""
    if len(data) <= RUN_BYTES:
        same = [pa.array(np.zeros(part.num_rows, bool)), pa.nulls(part.num_rows, pa.int64())]
        return [pa.RecordBatch.from_arrays([*part.columns, *same], ["doc_id", "text", "lead", "key"])]
    data, out, a, before = memoryview(data), [], 0, b""
    while a < len(data):
        cut = _BLANK.search(data, min(a + RUN_BYTES, len(data)))
        b = cut.start() if cut else len(data)
        run = before + bytes(data[a:b])
        row = [part.column("doc_id"), pa.array([run.decode("utf-8", "replace")], part.column("text").type), pa.array([bool(before)]), pa.array([key])]
        out.append(pa.RecordBatch.from_arrays(row, ["doc_id", "text", "lead", "key"]))
        last = bytes(data[a:b]).split()[-1:]
        before = last[0] + b" " if last else before
        a = b
    return out


def _chunks(docs: DataFrame) -> DataFrame:
    """Rows (chunk, ids, n, body): the runs' document ids, numbers of tokens and compressed texts."""

    def packed(chunk: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts)
        body = table.select(["text", "lead", "key"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, body.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(body)
        n = np.concatenate([np.bincount(_words(p.column("text").to_pylist())[3], minlength=p.num_rows) for p in parts])
        n = np.maximum(n - table.column("lead").to_numpy(), 0)
        ids, n = (pa.array([x], pa.list_(pa.int64())) for x in (table.column("doc_id").to_pylist(), n.tolist()))
        return pa.RecordBatch.from_arrays([pa.array([chunk]), ids, n, pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["chunk", "ids", "n", "body"])

    def work(batches):
        chunk, parts, size, long = TaskContext.get().partitionId() << 32, [], 0, 0
        first = chunk
        for batch in batches:
            for rows in slices(batch, "text", RUN_BYTES):
                long += 1
                for part in _runs(rows, first + long):
                    more = part.nbytes + 64 * part.num_rows
                    if parts and size + more > CHUNK_BYTES:
                        yield packed(chunk, parts)
                        chunk, parts, size = chunk + 1, [], 0
                    parts.append(part)
                    size += more
        if parts:
            yield packed(chunk, parts)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(work, "chunk long, ids array<long>, n array<long>, body binary")


def _body(body: pa.Scalar) -> tuple[list[str | None], np.ndarray, pa.Array]:
    """Texts, whether each begins with a word of the run before, and keys of texts that were cut."""
    rows = pa.ipc.open_stream(body.as_buffer()).read_all()
    return rows.column("text").to_pylist(), rows.column("lead").to_numpy(), rows.column("key").combine_chunks()


def _own(chunks: DataFrame, target_ids: DataFrame) -> DataFrame:
    """Rows (of, at, n): chunk, place in it and number of tokens of the target's documents."""
    ids = target_ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    places = chunks.select(F.col("chunk").alias("of"), F.posexplode(F.arrays_zip("ids", "n")).alias("at", "doc"))
    return places.select("of", "at", "doc.n", F.col("doc.ids").alias("doc_id")).join(ids, "doc_id", "left_semi").select("of", "at", "n")


def _asked(chunks: DataFrame, own: DataFrame, bits: int) -> DataFrame:
    """Rows (chunk, part, size, data): distinct hashes of a chunk within a range, its counts of them over all texts and
    over the target's."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {k: [] for k in ("chunk", "part", "size", "data")}
        if left.num_rows:
            texts, lead, _ = _body(left.column("body")[0])
            keys, word, pair, text, after, counts = grams(texts, lead)
            mine = np.zeros(len(texts), bool)
            mine[right.column("at").to_numpy()] = True
            mine = mine[text]
            every = np.bincount(word[counts], minlength=len(keys)) + np.bincount(pair, minlength=len(keys))
            chosen = np.bincount(word[mine & counts], minlength=len(keys)) + np.bincount(pair[mine[after]], minlength=len(keys))
            part = (keys >> np.uint64(64 - bits)).astype(np.int64)
            first = np.flatnonzero(np.diff(part, prepend=-1))
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(keys)]):
                step = np.diff(keys[a:b], prepend=np.uint64(0))
                new = (left.column("chunk")[0].as_py(), int(part[a]), b - a, _pack(step, every[a:b], chosen[a:b]))
                for column, value in zip(out.values(), new):
                    column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), kinds)})

    both = chunks.groupBy("chunk").cogroup(own.groupBy("of"))
    return both.applyInArrow(work, "chunk long, part long, size long, data binary")


def _answered(asked: DataFrame) -> DataFrame:
    """Rows (chunk, part, size, data): counts over all chunks of the hashes that a chunk asked for, in their order."""

    def work(rows: pa.Table) -> pa.Table:
        sizes = rows.column("size").to_numpy()
        parts = [_unpack(d.as_py(), n, 3) for d, n in zip(rows.column("data"), sizes.tolist())]
        keys, at = np.unique(np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts]), return_inverse=True)
        # sums stay below 2^53, where doubles are whole
        sums = [np.bincount(at, weights=np.concatenate([p[k] for p in parts]), minlength=len(keys)).astype(np.uint64) for k in (1, 2)]
        ends = np.cumsum(sizes)
        data = [_pack(*[s[at[b - n : b]] for s in sums]) for b, n in zip(ends.tolist(), sizes.tolist())]
        return pa.table({"chunk": rows.column("chunk"), "part": rows.column("part"), "size": rows.column("size"), "data": pa.array(data, pa.binary())})

    return asked.groupBy("part").applyInArrow(work, "chunk long, part long, size long, data binary")


def losses(every: np.ndarray, chosen: np.ndarray, n_every: int, n_chosen: int, word: np.ndarray, pair: np.ndarray, after: np.ndarray) -> list[np.ndarray]:
    """Loss of each token (nats) under the target and the background; counts are those of the places in ``word`` and ``pair``.

    Tokens are worked on ``BLOCK`` at a time: intermediate numbers take little memory, whatever the chunk."""
    scale = n_chosen / n_every if n_chosen else 1.0
    models = ((chosen, n_chosen, 1.0) if n_chosen else (every, n_every, 1.0), (every, n_every, scale))
    out, behind = [np.empty(len(word)), np.empty(len(word))], 0
    for a in range(0, len(word), BLOCK):
        w, then = word[a : a + BLOCK], np.flatnonzero(after[a : a + BLOCK])
        pairs = pair[behind : behind + len(then)]
        behind += len(then)
        pooled = (every[w] + 1.0) / (n_every + WORD_SLOTS)
        for losses_of, (counts, total, by) in zip(out, models):
            p = (counts[w] * by + POOLED * pooled) / (total * by + POOLED)
            p[then] = (counts[pairs] * by + BACKOFF * p[then]) / (counts[word[a + then - 1]] * by + BACKOFF)
            losses_of[a : a + BLOCK] = -np.log(p)
    return out


def score(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """One row per document: n_tokens, mean losses per token and their difference ``score``."""
    chunks = materialize(_chunks(docs), "chunks")
    bits = max(RANGES - 1, chunks.count() // CHUNKS_A_RANGE).bit_length()
    own = materialize(_own(chunks, target_ids), "own")
    n_every = chunks.select(F.explode("n").alias("n")).agg(F.sum("n")).first()[0] or 0
    n_chosen = own.agg(F.sum("n")).first()[0] or 0
    chunks = chunks.select("chunk", "ids", "body")
    answered = _answered(_asked(chunks, own.drop("n"), bits))

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        (texts, lead, cut), ids = _body(left.column("body")[0]), left.column("ids")[0].values
        keys, word, pair, text, after, counts = grams(texts, lead)
        right = right.sort_by("part")
        got = [_unpack(d.as_py(), n, 2) for d, n in zip(right.column("data"), right.column("size").to_pylist())]
        every, chosen = (np.concatenate([g[k] for g in got]).astype(np.float64) if got else np.zeros(0) for k in (0, 1))
        if len(every) != len(keys):
            raise ValueError(f"{len(every)} counts for {len(keys)} words and pairs")
        n = np.bincount(text[counts], minlength=len(texts)).astype(np.int64)
        sums = [np.bincount(text[counts], weights=x[counts], minlength=len(texts)) for x in losses(every, chosen, n_every, n_chosen, word, pair, after)]
        return pa.table([ids, cut, pa.array(n), *map(pa.array, sums)], ["doc_id", "cut", "n_tokens", "target", "background"])

    both = chunks.groupBy("chunk").cogroup(answered.groupBy("chunk"))
    runs = materialize(both.applyInArrow(work, "doc_id long, cut long, n_tokens long, target double, background double"), "runs")
    # only texts that were cut meet again
    parts = runs.where("cut is not null").groupBy("cut").agg(F.first("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in ("n_tokens", "target", "background")])
    rows = runs.where("cut is null").drop("cut").unionByName(parts.drop("cut"))
    n = F.when(F.col("n_tokens") > 0, F.col("n_tokens"))
    return rows.select(
        "doc_id", "n_tokens", (F.col("target") / n).alias("target_loss"), (F.col("background") / n).alias("background_loss"),
        (F.col("target") / n - F.col("background") / n).alias("score"),
    )
