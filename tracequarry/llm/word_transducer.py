"""BPE with word ends through a minimal acyclic transducer of frequent words.

Words are the pre-tokens of the model.  Their counts over all texts choose the
lexicon: the most frequent ones, whole classes of counts at a time.  It is compiled
into a minimal acyclic automaton that shares prefixes and suffixes; ids stand on its
arcs, as early as the words below them agree, so words with the same last tokens share
their ends.  The automaton is a file of sorted arcs that workers map; a batch's
distinct words walk through it together, a step for each byte.  A word that it doesn't
hold is merged by the model itself, so ids are those of the whole text whatever the
lexicon is.

No match of the pre-token pattern holds white space, and neither normal form nor case
reach over it, so texts are cut at ASCII white space and only chunks that a worker
doesn't remember are normalised and split.  Special tokens in a text get their ids, as in the
library's default.

Null text counts as empty; an empty or blank text has no ids and decodes to an empty
text.  Extra columns are not read.  No input row is dropped: repeated rows and null
ids give repeated rows; an empty table gives no rows.
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

from tracequarry.lineage import discard, materialize
from tracequarry.llm import mapped
from tracequarry.llm.bpe import Memo, _gather, slices

#: Most words of a lexicon, bytes of its longest word, and the count from which a word is frequent.
MOST_WORDS, LONGEST, FREQUENT = 1 << 16, 64, 2
#: Classes of counts for each doubling of the count.
CLASSES = 8
#: Distinct chunks and words that a counting task holds before it passes their sums on.
HELD = 1_000_000
#: Chunks that are normalised and split in one call.
TOGETHER = 4096
#: Stands before a special token's content where words are named; no pre-token has it.
_SPECIAL = "\0"


def _common(a, b) -> int:
    n = min(len(a), len(b))
    k = 0
    while k < n and a[k] == b[k]:
        k += 1
    return k


class _State:
    """A state on the path of the word that was added last: its arcs can still change."""

    __slots__ = ("arcs", "end")

    def __init__(self):
        self.arcs, self.end = [], None  # [byte, state below, ids], ids after the last byte (None: no word ends here)

    def push(self, ids: tuple) -> None:
        """Put ``ids`` in front of all that follows."""
        if ids:
            for arc in self.arcs:
                arc[2] = ids + arc[2]
            if self.end is not None:
                self.end = ids + self.end


def compile_words(entries: list[tuple[bytes, tuple[int, ...]]]) -> dict[str, np.ndarray]:
    """Arrays of the minimal transducer from distinct words, in ascending order, to their ids.

    ``keys``: 256 * state + byte of every arc, ascending; ``target`` and ``out`` by arc; ``end`` by state (-1: no word
    ends there); ``out`` and ``end`` name runs of ``ids`` between ``cuts``. State ``start[0]`` is the first."""
    frozen: dict[tuple, int] = {}

    def freeze(state: _State) -> int:
        return frozen.setdefault((state.end, tuple(map(tuple, state.arcs))), len(frozen))

    path, last = [_State()], b""
    for word, ids in entries:
        same, rest = _common(word, last), ids
        while len(path) > same + 1:
            below = freeze(path.pop())
            path[-1].arcs[-1][1] = below
        for k in range(same):
            arc = path[k].arcs[-1]
            n = _common(arc[2], rest)
            path[k + 1].push(arc[2][n:])
            arc[2], rest = arc[2][:n], rest[n:]
        for b in word[same:]:
            path[-1].arcs.append([b, None, rest])
            path.append(_State())
            rest = ()
        path[-1].end, last = rest, word
    while len(path) > 1:
        below = freeze(path.pop())
        path[-1].arcs[-1][1] = below
    start = freeze(path[0])
    runs: dict[tuple, int] = {(): 0}
    ends, arcs = [], []
    for (end, out), number in frozen.items():
        ends.append(-1 if end is None else runs.setdefault(end, len(runs)))
        arcs += [(number * 256 + b, below, runs.setdefault(ids, len(runs))) for b, below, ids in out]
    table = np.array(arcs, np.int64).reshape(-1, 3)
    return {
        "keys": table[:, 0].copy(), "target": table[:, 1].astype(np.int32), "out": table[:, 2].astype(np.int32), "end": np.array(ends, np.int32),
        "cuts": np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int64), "ids": np.array([i for r in runs for i in r], np.uint32),
        "start": np.array([start], np.int32),
    }


def look_up(lexicon: dict[str, np.ndarray], words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which words the lexicon holds, their ids one after another, and how many each word has (0 for others)."""
    raw = words.cast(pa.large_binary())
    at = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
    size = np.diff(at)
    keys, state = lexicon["keys"], np.full(len(raw), lexicon["start"][0], np.int64)
    alive = np.flatnonzero(size <= LONGEST) if len(keys) else np.empty(0, np.int64)
    held, said = np.zeros(len(raw), bool), []
    step = 0
    while len(alive):
        done = alive[size[alive] == step]
        end = lexicon["end"][state[done]]
        held[done[end >= 0]] = True
        said.append((done[end > 0], end[end > 0]))
        alive = alive[size[alive] > step]
        wanted = state[alive] * 256 + data[at[alive] + step]
        arc = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        there = keys[arc] == wanted
        alive, arc = alive[there], arc[there]
        state[alive] = lexicon["target"][arc]
        out = lexicon["out"][arc]
        said.append((alive[out > 0], out[out > 0]))
        step += 1
    who = np.concatenate([np.empty(0, np.int64), *[w for w, _ in said]])
    run = np.concatenate([np.empty(0, np.int64), *[r for _, r in said]]).astype(np.int64)
    whole = held[who]
    who, run = who[whole], run[whole]
    order = np.argsort(who, kind="stable")  # steps of a word stay in order
    who, run = who[order], run[order]
    lengths = np.diff(lexicon["cuts"])
    counts = np.bincount(who, lengths[run], len(raw)).astype(np.int64)
    return held, _gather(np.asarray(lexicon["ids"]), lexicon["cuts"][:-1], lengths, run), counts


class Words:
    """Cuts texts into the words of a model, and merges words by the model; one lives in each worker."""

    _made: dict[str, Words] = {}

    @classmethod
    def of(cls, model_json: str) -> Words:
        key = hashlib.sha256(model_json.encode()).hexdigest()
        if key not in cls._made:
            cls._made = {key: cls(model_json)}
        return cls._made[key]

    def __init__(self, model_json: str):
        import os

        import regex

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        spec = json.loads(model_json)
        own = Tokenizer.from_str(model_json)
        self.normalizer, self.splitter = own.normalizer, own.pre_tokenizer
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")" if self.special else r"(\b\B)")
        self.odd = "|".join([r"[\x{0b}\x{1c}-\x{1f}\x{85}\x{200b}\x{180e}\x{feff}\pZ]", *map(regex.escape, self.special)])
        spec |= {"added_tokens": [], "normalizer": None}
        self.merger = Tokenizer.from_str(json.dumps(spec))
        self.merger.pre_tokenizer = pre_tokenizers.Split(" ", "removed")
        self.merger.no_truncation()
        self.merger.no_padding()
        vocab = spec["model"]["vocab"]
        table = [""] * (max([*vocab.values(), *self.special.values(), -1]) + 1)
        for t, i in [*vocab.items(), *self.special.items()]:
            table[i] = t
        mark = spec["model"]["end_of_word_suffix"]
        self.last = np.array([t.endswith(mark) for t in table], bool)
        shown = [t.encode() + b" " for t in table]
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_n = np.array([len(t) for t in shown], np.int64)
        self.shown_at = np.cumsum(self.shown_n) - self.shown_n

    def _one(self, chunk: str) -> list[str]:
        out = []
        for k, part in enumerate(self.marks.split(chunk)):
            if k % 2:
                out.append(_SPECIAL + part)
            elif part:
                out += [w for w, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(part))]
        return out

    def split(self, chunks: pa.Array) -> tuple[list[str], np.ndarray]:
        """Words of the chunks one after another, and how many each chunk has; chunks have no ASCII white space."""
        odd = pc.match_substring_regex(chunks, self.odd).to_numpy(zero_copy_only=False)
        said, counts = chunks.to_pylist(), np.zeros(len(chunks), np.int64)
        plain, parts = np.flatnonzero(~odd), []
        for a in range(0, len(plain), TOGETHER):
            some = plain[a : a + TOGETHER]
            text = self.normalizer.normalize_str(" ".join([said[i] for i in some]))
            blanks = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), np.uint32) == 32)
            if len(blanks) != len(some) - 1:  # not seen: a chunk that gets or loses a blank
                odd[some] = True
                continue
            found = self.splitter.pre_tokenize_str(text)
            starts = np.array([at for _, (at, _) in found], np.int64)
            n = np.bincount(np.searchsorted(blanks, starts), minlength=len(some))
            counts[some] = n
            parts.append((some, [w for w, _ in found]))
        each = [(i, self._one(said[i])) for i in np.flatnonzero(odd)]
        for i, words in each:
            counts[i] = len(words)
        if not each:
            return [w for _, words in parts for w in words], counts
        flat, at = [""] * int(counts.sum()), np.cumsum(counts) - counts
        for some, words in parts:
            where = np.repeat(at[some], counts[some]) + _within(counts[some])
            for i, w in zip(where.tolist(), words):
                flat[i] = w
        for i, words in each:
            flat[at[i] : at[i] + len(words)] = words
        return flat, counts

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words by the model's merges, and how many each has."""
        ids, counts = [np.empty(0, np.uint32)], np.ones(len(words), np.int64)
        plain = [i for i, w in enumerate(words) if not w.startswith(_SPECIAL)]
        for a in range(0, len(plain), TOGETHER):
            some = plain[a : a + TOGETHER]
            got = np.array(self.merger.encode(" ".join([words[i] for i in some]), add_special_tokens=False).ids, np.uint32)
            ends = np.flatnonzero(self.last[got]) + 1
            counts[some] = np.diff(ends, prepend=0)
            ids.append(got)
        flat = np.concatenate(ids)
        if len(plain) == len(words):
            return flat, counts
        out, at = np.empty(int(counts.sum()), np.uint32), np.cumsum(counts) - counts
        out[np.repeat(at[plain], counts[plain]) + _within(counts[plain])] = flat
        for i, w in enumerate(words):
            if w.startswith(_SPECIAL):
                out[at[i]] = self.special[w[1:]]
        return out, counts

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the tokens, each with a blank behind it."""
        return _gather(self.shown, self.shown_at, self.shown_n, ids)


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def _chunks(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Runs without ASCII white space of all texts, and how many each text has."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    parts = parts.combine_chunks() if isinstance(parts, pa.ChunkedArray) else parts
    flat = parts.flatten().cast(pa.large_string())
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(full)])
    cuts = parts.offsets.to_numpy().astype(np.int64)
    counts = np.diff(before[cuts - cuts[0]])
    return (flat if full.all() else flat.filter(pa.array(full))), counts


def _summed(tables: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(tables).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])


def word_counts(docs: DataFrame, model_json: str, text: str = "text") -> DataFrame:
    """word (in the model's byte alphabet) and n of every word of all texts; a task passes on sums, never single words."""
    model = docs.sparkSession.sparkContext.broadcast(model_json)  # the vocabulary file's size
    source = docs.select(F.col(text).alias("text"))

    def words_of(chunks: pa.Table) -> pa.Table:
        words = Words.of(model.value)
        each = [pa.table({"word": pa.array([], pa.large_string()), "n": pa.array([], pa.int64())})]
        for a in range(0, len(chunks), HELD // 4):
            some = chunks.slice(a, HELD // 4)
            flat, counts = words.split(some.column("word").combine_chunks())
            each.append(pa.table({"word": pa.array(flat, pa.large_string()), "n": np.repeat(some.column("n").to_numpy(), counts)}))
        return _summed(each)

    def work(batches):
        held, rows, found = [], 0, []
        for batch in batches:
            for part in slices(batch, "text"):
                coded = _chunks(part.column("text"))[0].value_counts()
                held.append(pa.table({"word": coded.field("values"), "n": coded.field("counts").cast(pa.int64())}))
                rows += len(coded)
                if rows > HELD:
                    held = [_summed(held)]
                    rows = len(held[0])
                if rows > HELD // 2:
                    found.append(words_of(held[0] if len(held) == 1 else _summed(held)))
                    held, rows = [], 0
                    if sum(map(len, found)) > HELD:
                        found = [_summed(found)]
                    if len(found[0]) > HELD // 2:
                        yield from found.pop(0).to_batches(max_chunksize=65536)
        if held:
            found.append(words_of(_summed(held)))
        if found:
            yield from _summed(found).to_batches(max_chunksize=65536)

    def typed(batches):
        for batch in work(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), batch.column(1)], ["word", "n"])

    return source.mapInArrow(typed, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int = MOST_WORDS) -> list[str]:
    """Words of a lexicon, in byte order: the classes of counts, highest first, that hold at most ``most`` words together.

    Counts of one class (an eighth of a doubling) stay together, so ties don't depend on any order. Special tokens, words
    of more than ``LONGEST`` bytes and words found once are left to the model."""
    counts = counts.where(F.col("n") >= FREQUENT).where(~F.startswith("word", F.lit(_SPECIAL))).where(F.octet_length("word") <= LONGEST)
    kind = F.floor(F.log2("n") * CLASSES).cast("int")
    total, least = 0, None
    for k, n in sorted(counts.groupBy(kind.alias("k")).count().collect(), reverse=True):  # a few hundred classes
        total += n
        if total > most:
            break
        least = k
    if least is None:
        return []
    return sorted((r.word for r in counts.where(kind >= least).select("word").collect()), key=str.encode)  # at most ``most`` words


def lexicon(docs: DataFrame, model_json: str, text: str = "text", most: int = MOST_WORDS) -> dict[str, np.ndarray]:
    """The compiled lexicon of the frequent words of all texts."""
    counts = materialize(word_counts(docs, model_json, text), "words")
    words = frequent_words(counts, most)
    discard(counts)
    ids, n = Words.of(model_json).merge(words)
    flat, cuts = ids.tolist(), np.concatenate([[0], np.cumsum(n)]).tolist()
    return compile_words([(w.encode(), tuple(flat[a:b])) for w, a, b in zip(words, cuts, cuts[1:])])


class Encoder:
    """Encodes Arrow string arrays with a model and a mapped lexicon; one lives in each worker."""

    _made: dict[tuple, Encoder] = {}

    @classmethod
    def of(cls, model_json: str, path: str) -> Encoder:
        key = (hashlib.sha256(model_json.encode()).hexdigest(), path)
        if key not in cls._made:
            cls._made = {key: cls(Words.of(model_json), mapped.opened(path))}
        return cls._made[key]

    def __init__(self, words: Words, lexicon: dict[str, np.ndarray]):
        self.words, self.lexicon, self.memo = words, lexicon, Memo()

    def _fresh(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct chunks one after another, and how many each has."""
        flat, per_chunk = self.words.split(chunks)
        named = pa.array(flat, pa.large_string()).dictionary_encode()
        held, known, n = look_up(self.lexicon, named.dictionary)
        new = np.flatnonzero(~held)
        merged, counts = self.words.merge(named.dictionary.take(pa.array(new)).to_pylist())
        at = np.cumsum(n) - n
        at[new], n[new] = np.cumsum(counts) - counts + len(known), counts
        which = named.indices.to_numpy().astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(n[which])])[np.cumsum(per_chunk)]
        return _gather(np.concatenate([known, merged]), at, n, which), np.diff(ends, prepend=0)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the bounds of each text's ids."""
        chunks, per_text = _chunks(texts)
        coded = chunks.dictionary_encode()
        at = self.memo.find(coded.dictionary)
        known = at >= 0
        new = coded.dictionary.filter(pa.array(~known))
        ids, n = self._fresh(new)
        starts, counts = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        starts[known], counts[known] = self.memo.starts[at[known]], self.memo.counts[at[known]]
        starts[~known], counts[~known] = np.cumsum(n) - n + len(self.memo.flat), n
        flat = np.concatenate([self.memo.flat, ids])
        self.memo.hits[at[known]] += 1
        self.memo.add(new, flat, starts[~known], n)
        codes = coded.indices.to_numpy().astype(np.int64)
        return _gather(flat, starts, counts, codes), np.concatenate([[0], np.cumsum(counts[codes])])[np.concatenate([[0], np.cumsum(per_text)])]


def _shipped(docs: DataFrame, model_json: str, text: str, most: int):
    spark = docs.sparkSession
    name = mapped.ship(spark, "lexicon", lexicon(docs, model_json, text, most))  # at most ``most`` words
    model = spark.sparkContext.broadcast(model_json)  # the vocabulary file's size
    return lambda: Encoder.of(model.value, mapped.fetched(name))


def encode(docs: DataFrame, model_json: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), most: int = MOST_WORDS) -> DataFrame:
    """``keep`` columns plus ``ids`` and ``decoded``, the tokens with a blank between them."""
    encoder = _shipped(docs, model_json, text, most)
    source = docs.select(*keep, F.col(text).alias("__text"))
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder()
        for batch in batches:
            for part in slices(batch, "__text"):
                ids, bounds = enc.encode(part.column("__text"))
                data, edges = _decoded(enc, ids, bounds)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))
                texts = pa.array([data[a:b].decode() for a, b in edges], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists, texts], [*keep, "ids", "decoded"])

    return source.mapInArrow(work, f"{names}, ids array<int>, decoded string")


def _decoded(enc: Encoder, ids: np.ndarray, bounds: np.ndarray) -> tuple[bytes, list[tuple[int, int]]]:
    """Decoded bytes and each text's place in them, without the blank behind its last token."""
    data = enc.words.decode(ids).tobytes()
    cuts = np.concatenate([[0], np.cumsum(enc.words.shown_n[ids])])[bounds].tolist()
    return data, [(a, max(a, b - 1)) for a, b in zip(cuts, cuts[1:])]


def digests(docs: DataFrame, model_json: str, most: int = MOST_WORDS) -> DataFrame:
    """Encode whole texts, decode the ids: count and SHA-256 digests, the ids never leave the worker."""
    encoder = _shipped(docs, model_json, "text", most)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder()
        for batch in batches:
            for part in slices(batch, "text"):
                ids, bounds = enc.encode(part.column("text"))
                data, edges = _decoded(enc, ids, bounds)
                raw, cuts = memoryview(ids.astype("<u4", copy=False)), bounds.tolist()
                view = memoryview(data)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(np.diff(bounds)), pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(cuts, cuts[1:])]),
                        pa.array([hashlib.sha256(view[a:b]).hexdigest() for a, b in edges]),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
