"""Byte-level BPE encoding and decoding with the ``tokenizers`` library over Arrow batches.

A rank file is turned into a ``tokenizers`` model in which every split of a
token into two tokens is a merge, ordered by the token's rank: the rule by
which rank-based encoders merge.  Tokenizers are never trained here.

Pre-tokens of the public pattern hold a space only as their first character or
inside a run of white space, so a text may be cut at every space between two
characters that aren't white space.  These chunks repeat a lot: each batch is
cut and dictionary-encoded by Arrow, only chunks not seen before go through
the library, and ids are gathered by position.  Whatever the batches are, the
ids are those of the whole text.

Null text counts as empty; an empty text has no ids.  Extra columns are not
read.  No input row is dropped: repeated rows and null ids give repeated rows.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of text that are encoded at once; bounds a worker's memory.
BATCH_CHARS = 8_000_000
#: Chunks whose ids a worker remembers between batches.
MEMO_CHUNKS = 1_000_000
#: White space in any sense that a pre-token pattern may use; more is harmless.
_BLANK = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\x{200b}\x{180e}\x{feff}\pZ"
_ODD = f"[{_BLANK}] | [{_BLANK}]|^ | $"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    chars, spare = [""] * 256, 0x100
    for b in range(256):
        if b in plain:
            chars[b] = chr(b)
        else:
            chars[b], spare = chr(spare), spare + 1
    return chars


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}


def model_from_ranks(ranks: dict[bytes, int], pattern: str) -> str:
    """The ``tokenizers`` JSON that merges by these ranks inside each match of ``pattern``."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    chars = byte_alphabet()
    shown = {t: "".join(chars[b] for b in t) for t in ranks}
    merges = [
        (shown[t[:i]], shown[t[i:]])
        for t in sorted(ranks, key=ranks.get)
        for i in range(1, len(t))
        if t[:i] in ranks and t[i:] in ranks
    ]
    model = models.BPE({shown[t]: r for t, r in ranks.items()}, merges, ignore_merges=True)
    tok = Tokenizer(model)
    tok.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    return tok.to_str()


def read_model(path: str) -> str:
    """A ``tokenizers`` JSON file as text, to be sent to the executors."""
    with open(path, encoding="utf-8") as f:
        return f.read()


class Memo:
    """Ids of chunks seen before; when there are too many, those found most often stay."""

    def __init__(self):
        self.words = pa.array([], pa.large_string())
        self.flat = np.empty(0, np.uint32)
        self.starts = self.counts = self.hits = np.empty(0, np.int64)

    def find(self, words: pa.Array) -> np.ndarray:
        """Place of each word, -1 for new ones."""
        return pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False)

    def add(self, words: pa.Array, flat: np.ndarray, starts: np.ndarray, counts: np.ndarray):
        """New words; ``flat`` holds the ids of the old ones in front."""
        self.words, self.flat = pa.concat_arrays([self.words, words]), flat
        self.starts, self.counts = np.concatenate([self.starts, starts]), np.concatenate([self.counts, counts])
        self.hits = np.concatenate([self.hits, np.ones(len(words), np.int64)])
        if len(self.words) > MEMO_CHUNKS or len(flat) > 8 * MEMO_CHUNKS:
            short = np.flatnonzero(pc.binary_length(self.words).to_numpy() < 64)
            keep = np.sort(short[np.argsort(-self.hits[short], kind="stable")[: MEMO_CHUNKS // 2]])
            self.words = self.words.take(pa.array(keep))
            self.flat = _gather(flat, self.starts, self.counts, keep)
            self.counts, self.hits = self.counts[keep], self.hits[keep] // 2
            self.starts = np.cumsum(self.counts) - self.counts


class Codec:
    """Encodes Arrow string arrays and decodes ids; one lives in each worker."""

    _made: dict[str, Codec] = {}

    @classmethod
    def of(cls, model_json: str, chunked: bool) -> Codec:
        key = hashlib.sha256(model_json.encode()).hexdigest() + str(chunked)
        if key not in cls._made:
            cls._made = {key: cls(model_json, chunked)}
        return cls._made[key]

    def __init__(self, model_json: str, chunked: bool = True):
        import os

        import regex

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(model_json)
        self.tok.encode_special_tokens = True
        self.tok.no_truncation()
        self.tok.no_padding()
        self.chunked = chunked
        back = {c: b for b, c in enumerate(byte_alphabet())}
        spec = json.loads(model_json)
        vocab = spec["model"]["vocab"]
        added = {t["id"]: t["content"].encode() for t in spec.get("added_tokens", ())}
        table = [b""] * (max([*vocab.values(), *added, -1]) + 1)
        for t, i in vocab.items():
            table[i] = bytes(back[c] for c in t) if all(c in back for c in t) else t.encode()
        for i, t in added.items():
            table[i] = t
        self.lengths = np.array([len(t) for t in table], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.bytes = np.frombuffer(b"".join(table), np.uint8)
        self.memo = {True: Memo(), False: Memo()}  # chunks with and without a space before them
        solid = r"[^\s\x0b\x1c-\x1f\x85\u200b\u180e\ufeff\p{Z}]"
        self.cut = regex.compile(rf"(?<={solid}) (?={solid})")

    def _raw(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    def _fresh(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of chunks that start and end with no white space, but for a leading space, and how many each has.

        Many go through the library as one text; token lengths tell them apart."""
        flat, counts = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for a in range(0, len(chunks), 1024):
            some = chunks[a : a + 1024]
            ids = self._raw(["".join(some)])[0]
            ends = np.cumsum(self.lengths[ids])
            marks = np.searchsorted(ends, np.cumsum([len(c.encode()) for c in some]), side="left") + 1
            flat.append(ids)
            counts.append(np.diff(marks, prepend=0))
        return np.concatenate(flat), np.concatenate(counts)

    def _unique(self, chunks: pa.Array, space: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat ids of distinct chunks, where each one's begin and how many it has."""
        memo = self.memo[space]
        at = memo.find(chunks)
        new = chunks.filter(pa.array(at < 0)) if (at < 0).any() else chunks.slice(0, 0)
        if space:
            flat, n = self._fresh([" " + c for c in new.to_pylist()])
        else:
            each = self._raw(new.to_pylist())
            flat, n = np.concatenate([np.empty(0, np.uint32), *each]), np.array([len(x) for x in each], np.int64)
        starts, counts = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        known = at >= 0
        starts[known], counts[known] = memo.starts[at[known]], memo.counts[at[known]]
        starts[~known], counts[~known] = np.cumsum(n) - n + len(memo.flat), n
        both = np.concatenate([memo.flat, flat])
        memo.hits[at[known]] += 1
        memo.add(new, both, starts[~known], n)
        return both, starts, counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the bounds of each text's ids."""
        texts = pc.fill_null(texts, "")
        if not self.chunked:
            each = self._raw(texts.to_pylist())
            return np.concatenate([np.empty(0, np.uint32), *each]), np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int64)
        odd = pc.match_substring_regex(texts, _ODD)
        parts = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        parts = parts.combine_chunks() if isinstance(parts, pa.ChunkedArray) else parts
        starts, sizes = parts.offsets.to_numpy()[:-1].astype(np.int64), np.diff(parts.offsets.to_numpy()).astype(np.int64)
        starts -= parts.offsets[0].as_py()
        chunks = parts.flatten().cast(pa.large_string())
        if pc.any(odd).as_py():  # texts with other white space are cut by the library of patterns, and follow the others
            rows = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
            cut = [self.cut.split(t) for t in texts.filter(odd).to_pylist()]
            sizes[rows] = [len(c) for c in cut]
            starts[rows] = len(chunks) + np.cumsum(sizes[rows]) - sizes[rows]
            chunks = pa.concat_arrays([chunks, pa.array([c for some in cut for c in some], pa.large_string())])
        # the first chunk of a text has no space before it; an odd one may hold white space anywhere
        first = chunks.take(pa.array(starts)).dictionary_encode()
        coded = chunks.dictionary_encode()
        codes = _gather(coded.indices.to_numpy(), starts, sizes, np.arange(len(sizes))).astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        codes[bounds[:-1]] = first.indices.to_numpy() + len(coded.dictionary)
        # chunks that are nowhere but in front need no ids with a space
        used = np.zeros(len(coded.dictionary), bool)
        used[codes[codes < len(used)]] = True
        flat_a, at_a, n_a = self._unique(coded.dictionary.filter(pa.array(used)), True)
        flat_b, at_b, n_b = self._unique(first.dictionary, False)
        place = np.cumsum(used) - 1
        at = np.concatenate([at_a[place] if len(at_a) else np.zeros(len(used), np.int64), at_b + len(flat_a)])
        n = np.concatenate([n_a[place] if len(n_a) else np.zeros(len(used), np.int64), n_b])
        ids = _gather(np.concatenate([flat_a, flat_b]), at, n, codes)
        sums = np.concatenate([[0], np.cumsum(n[codes])])
        return ids, sums[bounds]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids, as unsigned 8-bit numbers."""
        return _gather(self.bytes, self.starts, self.lengths, ids)


def _gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> np.ndarray:
    """flat[starts[w] : starts[w] + lengths[w]] for each w of which, one after another."""
    n = lengths[which]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(flat)) < 2**31 else np.int64
    at = np.repeat((starts[which] - ends + n).astype(kind), n)
    at += np.arange(total, dtype=kind)
    return flat[at]


def slices(batch: pa.RecordBatch, column: str, most: int = BATCH_CHARS, most_rows: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """The batch in runs of at most ``most_rows`` rows of about ``most`` bytes of text; a longer text stands alone."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64))
    a = 0
    while a < batch.num_rows:
        done = size[a - 1] if a else 0
        b = min(a + most_rows, max(a + 1, int(np.searchsorted(size, done + most, side="right"))))
        yield batch.slice(a, b - a)
        a = b


def _shared(df: DataFrame, model_json: str):
    return df.sparkSession.sparkContext.broadcast(model_json)  # the vocabulary file's size


def encode(df: DataFrame, model_json: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), chunked: bool = True) -> DataFrame:
    """``keep`` columns plus ``ids`` and where each token starts, in bytes and in characters.

    A token that starts inside a character has that character's position.
    ``chunked`` is for patterns whose matches hold a space only in front."""
    model = _shared(df, model_json)
    source = df.select(*keep, F.col(text).alias("__text"))
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema)

    def work(batches):
        codec = Codec.of(model.value, chunked)
        for batch in batches:
            for part in slices(batch, "__text"):
                ids, bounds = codec.encode(part.column("__text"))
                raw = codec.decode(ids)
                at = np.cumsum(codec.lengths[ids]) - codec.lengths[ids]
                heads = np.cumsum((raw & 0xC0) != 0x80)  # of each byte: characters begun so far
                at_char = heads[at] - 1 if len(at) else at
                base = np.concatenate([at, [len(raw)]])[bounds]
                base_char = np.concatenate([[0], heads])[base]
                n = np.diff(bounds)
                offsets = pa.array(bounds.astype(np.int32))
                lists = [
                    pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32)))
                    for x in (ids, at - np.repeat(base[:-1], n), at_char - np.repeat(base_char[:-1], n))
                ]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *lists], [*keep, "ids", "byte_starts", "char_starts"])

    return source.mapInArrow(work, f"{names}, ids array<int>, byte_starts array<int>, char_starts array<int>")


def decode(df: DataFrame, model_json: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus ``data``, the bytes, and ``text``.

    Characters split over tokens are whole again in ``text`` as bytes are joined first; bytes that
    are no UTF-8 become U+FFFD.  Null ids count as none."""
    model = _shared(df, model_json)
    source = df.select(*keep, F.coalesce(F.col(ids).cast("array<int>"), F.expr("cast(array() as array<int>)")).alias("__ids"))
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema)

    def work(batches):
        codec = Codec.of(model.value, True)
        for batch in batches:
            data = [codec.decode(np.array(x, np.int64)).tobytes() for x in batch.column("__ids").to_pylist()]
            texts = [x.decode("utf-8", "replace") for x in data]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(data, pa.binary()), pa.array(texts, pa.string())], [*keep, "data", "text"])

    return source.mapInArrow(work, f"{names}, data binary, text string")


def digests(df: DataFrame, model_json: str, chunked: bool = True) -> DataFrame:
    """Encode whole texts, decode the ids: count and SHA-256 digests, the ids never leave the worker."""
    model = _shared(df, model_json)

    def work(batches):
        codec = Codec.of(model.value, chunked)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, bounds = codec.encode(part.column("text"))
                data = codec.decode(ids)
                edges = np.concatenate([[0], np.cumsum(codec.lengths[ids])])[bounds].tolist()
                ids, cuts = ids.astype("<u4", copy=False), bounds.tolist()
                of_ids = [hashlib.sha256(ids[a:b]).hexdigest() for a, b in zip(cuts, cuts[1:])]
                of_data = [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(edges, edges[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(bounds)), pa.array(of_ids), pa.array(of_data)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return df.select("doc_id", "text").mapInArrow(work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
