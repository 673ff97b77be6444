"""Quality rules: base counts, and divergence of histograms from language references.

All counts are DataFrame expressions over the row's own text: nothing is exploded
or shuffled for them, so a row's cost depends on its own length only.  A first
pass keeps the counts (no text); histograms of character classes and of common
words are summed by language over all rows that pass the base rule and become the
references; a second pass takes the Jensen-Shannon distance from each row to the
nearest reference.  A row whose own language has no reference isn't measured by those of
other languages: it stays if most of what it writes are letters and digits.

Words are runs of anything but ASCII white space.  Null text has no words, so all
its counts are 0 and it fails the base rule.  Rows of null or rare ``lang`` values
count in the pooled reference only, which is one of those that all are compared with.  Repeated rows
and null ids are judged like any other row; an empty table gives no rows.  Extra
columns are not read by :func:`judge`, and kept untouched by :func:`keep_good`,
whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracequarry.lineage import materialize

# Frequent function words of some languages, and character classes.
COMMON_WORDS = (
    "the of and to in is that for with was it on as by be this are from or have "
    "de la le les et des en un une du que qui dans pour par sur est el los las y "
    "se por con para una der die das und zu den mit von ist im für auf nicht ein "
    "eine dem sich"
).split()
SYMBOLS = "#*$%&|<>"
PUNCTUATION = ".,;:!?'\"()-"
SPACE = " \t\n\x0b\f\r"

#: A language has a reference if so many of its rows pass the base rule, and this share of what they write are letters;
#: the same share, of letters and digits, is asked of each row whose language has none.
MIN_ROWS, MIN_LETTERS = 50, 0.6
#: Rows with fewer characters or words than these are not judged by a histogram.
MIN_CHARS, MIN_WORDS = 200, 200
#: Largest Jensen-Shannon distance (base 2, 0 to 1) to the nearest reference.
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.30, 0.30

CLASSES = ("lower", "space", "upper", "letter", "digit", "punctuation", "symbol", "other")


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once even where ``body`` repeats it in a lambda."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words that stand in a 3-word window found twice or more in the row."""

    def covered(windows: Column) -> Column:
        """windows: hash of each window. Sorted by hash, equal windows are neighbours."""
        by_hash = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def flagged(rows: Column) -> Column:
            return F.filter(
                rows,
                lambda x, k: F.coalesce(F.get(rows, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(rows, k + 1)["h"] == x["h"], F.lit(False)),
            )

        places = let(by_hash, lambda rows: F.sort_array(F.transform(flagged(rows), lambda x: x["i"])))
        return let(
            places,
            lambda at: F.aggregate(
                F.transform(at, lambda p, k: F.when(k == 0, 3).otherwise(F.least(F.lit(3), p - F.get(at, k - 1)))),
                F.lit(0).cast("long"),
                lambda total, x: total + x,
            ),
        )

    def counted(w: Column) -> Column:
        n = F.size(w)
        windows = F.transform(
            F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        )
        return F.when(
            n >= 3,
            let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h))),
        ).otherwise(F.lit(0).cast("long"))

    return let(words, counted)


def _outside(text: Column, kept: str) -> Column:
    return F.regexp_replace(text, kept, "")


def profile(docs: DataFrame, keep: list[Column]) -> DataFrame:
    """``keep`` plus the struct ``q``: base counts and histograms of each row."""
    split_at = r"[ \t-\r]+"
    text = F.coalesce(F.col("text"), F.lit(""))
    stage = docs.select(*keep, text.alias("__t"))
    trimmed = F.btrim("__t", F.lit(SPACE))
    stage = stage.withColumns(
        {
            "__w": F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, split_at)),
            "__rest": _outside(F.col("__t"), r"[a-z \t-\r]+"),
            "__lines": F.filter(F.split("__t", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != ""),
            "__common": F.concat(
                F.lit(" "),
                F.array_join(F.filter(F.split(F.lower("__t"), r"[^\p{L}]+"), lambda x: x.isin(COMMON_WORDS)), "  "),
                F.lit(" "),
            ),
        }
    )
    t, w, rest, lines, common = (F.col(f"__{x}") for x in ("t", "w", "rest", "lines", "common"))
    n_chars, word_chars = F.length(t), F.length(F.array_join(w, ""))

    def lost(pattern: str) -> Column:
        return F.length(rest) - F.length(_outside(rest, pattern))

    # a word with its own spaces is cut out wherever it stands: what the text loses tells how often
    times = [
        ((F.length(common) - F.length(F.replace(common, F.lit(f" {word} "), F.lit("")))) / (len(word) + 2)).cast("int") for word in COMMON_WORDS
    ]
    counts = {
        "upper": lost(r"\p{Lu}+"),
        "letter": lost(r"[\p{L}&&[^\p{Lu}]]+"),
        "digit": lost(r"\p{N}+"),
        "punctuation": lost("[" + "".join("\\" + x for x in PUNCTUATION) + "]+"),
        "symbol": lost("[" + "".join("\\" + x for x in SYMBOLS) + "]+"),
    }
    counted = stage.select(
        *[F.col(c) for c in stage.columns if not c.startswith("__") or c == "__row"],
        F.size(w).cast("long").alias("__n"),
        n_chars.cast("long").alias("__chars"),
        word_chars.cast("long").alias("__word_chars"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("__dup"),
        repeated_words(w).alias("__rep"),
        F.length(rest).alias("__left"),
        *[x.alias(f"__c_{k}") for k, x in counts.items()],
        F.array(*times).alias("__times"),
    )
    c = {k: F.col(f"__c_{k}").cast("long") for k in counts}
    space = F.col("__chars") - F.col("__word_chars")
    classes = {
        "lower": F.col("__chars") - F.col("__left") - space,
        "space": space,
        **c,
        "other": F.col("__left") - reduce(lambda a, b: a + b, c.values()),
    }
    hits = F.aggregate("__times", F.lit(0).cast("long"), lambda a, x: a + x)
    return counted.select(
        *[F.col(x) for x in counted.columns if not x.startswith("__") or x == "__row"],
        F.struct(
            F.col("__n").alias("n_words"),
            F.col("__word_chars").alias("word_chars"),
            c["symbol"].alias("n_symbols"),
            F.col("__dup").alias("n_dup_lines"),
            F.col("__rep").alias("n_repeat_words"),
            F.col("__chars").alias("n_chars"),
            F.array(*[classes[k] for k in CLASSES]).alias("classes"),
            F.concat(F.transform("__times", lambda x: x.cast("long")), F.array(F.greatest(F.col("__n") - hits, F.lit(0).cast("long")))).alias("words"),
        ).alias("q"),
    )


def failed(q: Column) -> Column:
    """The base rule."""
    return (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])


def references(profiles: DataFrame, lang: str = "lang") -> DataFrame:
    """Class and word distributions (ref_lang, ref_classes, ref_words) of rows that pass the base rule, one row a language.

    The row with a null language is pooled over all rows. Languages of few rows, or whose rows are hardly letters (junk
    under a label of its own), have none."""
    n_classes, n_words = len(CLASSES), len(COMMON_WORDS) + 1
    good = profiles.where(~failed(F.col("q")))
    sums = good.groupBy(F.col(lang).alias("ref_lang")).agg(
        F.count("*").alias("n"),
        *[F.sum(F.col("q.classes")[i]).alias(f"c{i}") for i in range(n_classes)],
        *[F.sum(F.col("q.words")[i]).alias(f"w{i}") for i in range(n_words)],
    )
    sums = materialize(sums, "references")
    pooled = sums.agg(F.lit(None).cast("string").alias("ref_lang"), *[F.sum(c).alias(c) for c in sums.columns if c != "ref_lang"])
    at = {k: F.col(f"c{i}") for i, k in enumerate(CLASSES)}
    written = reduce(lambda a, b: a + b, [c for k, c in at.items() if k != "space"])
    letters = at["lower"] + at["upper"] + at["letter"] >= MIN_LETTERS * written
    own = sums.where((F.col("ref_lang").isNotNull()) & (F.col("n") >= MIN_ROWS) & letters)

    def shares(kind: str, n: int) -> Column:
        counts = [F.col(f"{kind}{i}") for i in range(n)]
        total = reduce(lambda a, b: a + b, counts)
        return F.array(*[c / total for c in counts])

    return own.unionByName(pooled.where("n > 0")).select("ref_lang", shares("c", n_classes).alias("ref_classes"), shares("w", n_words).alias("ref_words"))


def distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (square root of the divergence, base 2) of counts to a distribution."""

    def halves(p: Column, q: Column) -> Column:
        m = (p + q) / 2
        term = lambda x: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
        return (term(p) + term(q)) / 2

    def against(total: Column) -> Column:
        terms = F.zip_with(counts, reference, lambda n, q: halves(n / total, q))
        return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x), F.lit(0.0)))

    return let(F.aggregate(counts, F.lit(0.0), lambda a, x: a + x), lambda total: F.when(total > 0, against(total)))


def verdicts(profiles: DataFrame) -> DataFrame:
    """The profiles plus ``class_distance``, ``word_distance``, ``base_failed`` and ``kept``.

    Distances are those to the nearest reference, so that texts of several languages or of another one than their label
    says stay. They decide on rows whose language has a reference of its own; a language of few rows is not judged by
    others' words, its rows only have to be letters and digits for the most part. All references are one row, which Spark
    broadcasts if it is small enough for that."""
    one = references(profiles).agg(F.collect_list(F.struct("ref_lang", "ref_classes", "ref_words")).alias("refs"))
    q = F.col("q")
    own = F.coalesce(F.array_contains(F.transform("refs", lambda r: r["ref_lang"]), F.col("lang")), F.lit(False))
    at = {k: q["classes"][i] for i, k in enumerate(CLASSES)}
    written = reduce(lambda a, b: a + b, [c for k, c in at.items() if k != "space"])
    plain = at["lower"] + at["upper"] + at["letter"] + at["digit"] >= MIN_LETTERS * written

    def nearest(counts: Column, kind: str) -> Column:
        return F.array_min(F.transform("refs", lambda r: distance(counts, r[kind])))

    out = profiles.crossJoin(one).withColumns(
        {
            "base_failed": failed(q),
            "class_distance": F.when(q["n_chars"] >= MIN_CHARS, nearest(q["classes"], "ref_classes")),
            "word_distance": F.when(q["n_words"] >= MIN_WORDS, nearest(q["words"], "ref_words")),
        }
    )
    near = (F.coalesce("class_distance", F.lit(0.0)) <= MAX_CLASS_DISTANCE) & (F.coalesce("word_distance", F.lit(0.0)) <= MAX_WORD_DISTANCE)
    return out.withColumn("kept", ~F.col("base_failed") & F.when(own, near).otherwise(plain)).drop("refs")


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: base counts, distances and whether it is kept."""
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    profiles = materialize(profile(docs, [F.col("doc_id"), lang.alias("lang")]), "profiles")
    q = [F.col(f"q.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    distances = [F.round(c, 6).alias(c) for c in ("class_distance", "word_distance")]
    return verdicts(profiles).select("doc_id", *q, "base_failed", "kept", *distances)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that the rules keep."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    profiles = materialize(profile(docs, [row.alias("__row"), lang.alias("lang")]), "profiles")
    return verdicts(profiles).where("kept").select("__row.*")
