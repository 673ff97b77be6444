import math
import os
import re
from collections import Counter

import pytest

from tracequarry.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def histograms(text):
    import regex

    text = text or ""
    kinds = Counter()
    for c in text:
        if "a" <= c <= "z":
            kinds["lower"] += 1
        elif c in quality.SPACE:
            kinds["space"] += 1
        elif regex.match(r"\p{Lu}", c):
            kinds["upper"] += 1
        elif regex.match(r"\p{L}", c):
            kinds["letter"] += 1
        elif regex.match(r"\p{N}", c):
            kinds["digit"] += 1
        elif c in quality.PUNCTUATION:
            kinds["punctuation"] += 1
        elif c in quality.SYMBOLS:
            kinds["symbol"] += 1
        else:
            kinds["other"] += 1
    found = Counter(w for w in regex.split(r"[^\p{L}]+", text.lower()) if w in quality.COMMON_WORDS)
    n = len(WORD.findall(text))
    return [kinds[k] for k in quality.CLASSES], [found[w] for w in quality.COMMON_WORDS] + [max(0, n - sum(found.values()))]


def js(p, q):
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    kl = lambda a: sum(x * math.log2(x / y) for x, y in zip(a, m) if x > 0)
    return math.sqrt(max(0, (kl(p) + kl(q)) / 2))


def brute(rows):
    """rows: doc_id, text, lang."""
    each = [(d, t or "", lang, base(t), *histograms(t)) for d, t, lang in rows]
    failed = lambda b: b[0] < 50 or 100 * b[4] > 50 * b[0]
    refs = {}
    for _, _, lang, b, c, w in each:
        for key in {None, lang}:
            if not failed(b):
                r = refs.setdefault(key, [[0] * len(c), [0] * len(w), 0])
                refs[key] = [[x + y for x, y in zip(r[0], c)], [x + y for x, y in zip(r[1], w)], r[2] + 1]
    kinds = dict(zip(quality.CLASSES, range(99)))
    for key, (c, _, n) in list(refs.items()):
        letters = sum(c[kinds[k]] for k in ("lower", "upper", "letter"))
        if key is not None and (n < quality.MIN_ROWS or letters < quality.MIN_LETTERS * (sum(c) - c[kinds["space"]])):
            del refs[key]
    out = []
    for d, t, lang, b, c, w in each:
        dc = min((js(c, r[0]) for r in refs.values()), default=None) if len(t) >= quality.MIN_CHARS else None
        dw = min((js(w, r[1]) for r in refs.values()), default=None) if b[0] >= quality.MIN_WORDS else None
        near = (dc or 0) <= quality.MAX_CLASS_DISTANCE and (dw or 0) <= quality.MAX_WORD_DISTANCE
        plain = sum(c[kinds[k]] for k in ("lower", "upper", "letter", "digit")) >= quality.MIN_LETTERS * (sum(c) - c[kinds["space"]])
        kept = not failed(b) and (near if lang is not None and lang in refs else plain)
        out.append((d, *b, failed(b), kept, dc, dw))
    return out


def compare(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:8] == w[:8], (g, w)
        for a, b in zip(g[8:], w[8:]):
            assert (a is None) == (b is None) and (a is None or abs(a - b) < 1e-6)


PROSE = "The cat and the dog of the house went to a river, for it was the time of day. Then all of them slept by it with a friend "
ROWS = [
    (1, PROSE * 1 + " ".join(f"w{i}" for i in range(60)), "en"),
    (1, PROSE * 1 + " ".join(f"w{i}" for i in range(60)), "en"),
    (2, PROSE * 9, "en"),
    (3, None, "en"),
    (4, "", None),
    (5, "a b c a b c a b", "fr"),
    (6, "x\nx\n \n x\ny\r\ny\r\n", None),
    (None, "Été à la plage, où l'île ß 北京 🙂 $$$ ### 12½ " + " ".join(f"é{i}" for i in range(90)), "fr"),
    (8, "\x0b\x0c # <b> *&|% " * 40, "xx"),
    (9, " ".join(f"k{i % 9000}" for i in range(30000)), "en"),
    (10, "same " * 20000, "en"),
    (11, "one two", "en"),
    (12, "one two three", "en"),
    (13, "q " * 3, "en"),
]


@pytest.mark.parametrize("least", [quality.MIN_ROWS, 1])
def test_rows_against_brute_force(spark, monkeypatch, least):
    monkeypatch.setattr(quality, "MIN_ROWS", least)
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string").selectExpr("*", "1 as n_words", "2 as q", "'x' as __t")
    compare(quality.judge(docs).collect(), brute(ROWS))
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == sorted((r[0] or -1) for r in brute(ROWS) if r[7])


def test_empty_and_without_lang(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    assert quality.judge(docs.limit(0)).count() == 0
    compare(quality.judge(docs.drop("lang")).collect(), brute([(d, t, None) for d, t, _ in ROWS]))


def test_junk_under_its_own_label_goes_and_every_language_has_a_reference(spark):
    prose = [(i, PROSE * 1 + " ".join(f"{chr(97 + k)}{chr(97 + j)}" for k in range(20) for j in range(i % 5 + 3)), f"l{i % 100}") for i in range(6000)]
    junk = [(10_000 + i, " ".join(f"{'#$%&'[(i * k) % 4]}*{'|<>'[(i + k) % 3]}{k}" for k in range(300)), "xx") for i in range(200)]
    alone = [(20_000, junk[3][1], "yy"), (20_001, prose[0][1], "rare"), (20_002, prose[1][1], None)]
    alone += [(30_000, PROSE * 3 + " ".join(f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst") + " les gens de la ville et du port", "l3")]
    docs = spark.createDataFrame(prose + junk + alone, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert got[30_000].kept  # half of each of two languages
    assert all(got[i].kept for i, *_ in prose) and not any(got[i].kept for i, *_ in junk)
    assert not got[20_000].kept and got[20_001].kept and got[20_002].kept
    refs = {r.ref_lang for r in quality.references(quality.profile(docs, [lid for lid in (quality.F.col("lang"),)])).collect()}
    assert refs == {None, *(f"l{k}" for k in range(100))}


@pytest.mark.parametrize("n", [1, 10, 40, 60, 1000])
def test_small_languages_stay_as_large_ones_do(spark, n):
    """Texts in another script, without one of the common words, beside prose in a language of many rows."""
    said = lambda i, first: " ".join(chr(first + k % 26) + chr(first + k // 26) + chr(first + i % 26) for k in range(300))
    english = [(i, PROSE * 2 + said(i, 97), "en") for i in range(400)]
    other = [(1000 + i, said(i, 0x430), "ru") for i in range(n)]
    noise = [(9000, "#$ %& " * 300 + " ".join(f"#{k}" for k in range(900)), "ru"), (9001, "#$ %& " * 300 + " ".join(f"#{k}" for k in range(900)), None)]
    docs = spark.createDataFrame(english + other + noise, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in quality.judge(docs).where("kept").collect()}
    assert kept == {d for d, *_ in english + other}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_no_language_loses_a_tenth(spark, sf):
    got = quality.judge(spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")).where("not base_failed")
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "lang")
    for r in got.join(docs, "doc_id").groupBy("lang").count().collect():
        lost = got.join(docs, "doc_id").where(f"lang = '{r.lang}' and not kept").count()
        assert lost <= 0.1 * r["count"], r.lang


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_whole_table_against_brute_force(spark):
    from tracequarry.llm.queries import op10_quality_rules

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang").collect()
    compare(op10_quality_rules(spark, "/root/testdata/sf0.01").collect(), brute([tuple(d) for d in docs]))
