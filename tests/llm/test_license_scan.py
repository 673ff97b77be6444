import re

import pytest

from tracequarry.llm import license_scan as ls

PHRASES = [(p.split(), label) for p, label in ls.PHRASES]


def test_words():
    assert ls.words_of("CC-BY_NC é4.0\x00Ä") == [b"cc", b"by", b"nc", "é4".encode(), b"0", "Ä".encode()]
    assert ls.words_of(None) == ls.words_of(" ,.") == []


@pytest.mark.parametrize(
    ("template", "yes", "no"),
    [
        ("a <<optional>>b c<<end>> d", ["a d", "a b c d"], ["a b d", "a c d", "a b c"]),
        ("a <<var:1-2>> b", ["a x b", "a x y b", "a b b"], ["a b", "a x y z b"]),
        ("a <<optional>>b <<optional>>c<<end>><<end>> d", ["a d", "a b d", "a b c d"], ["a c d"]),
        ("<<optional>>the<<end>> end", ["the end", "end"], ["the"]),
        ("<<var:0-1>> z", ["z", "q z"], ["q"]),
    ],
)
def test_automata(template, yes, no):
    scanner = ls.Scanner([("t", template)], [])
    for t in yes:
        assert scanner.scan(f"so {t}, then")[5] == "t", t
    for t in no:
        assert scanner.scan(t)[5] == "", t


@pytest.mark.parametrize("bad", ["a <<end>>", "<<optional>>a", "<<optional>>a<<end>>", "<<var:3-1>> a", ""])
def test_bad_markup(bad):
    with pytest.raises(ValueError):
        ls.compile_template("x", bad)


def base(text):
    words = [w.decode() for w in ls.words_of(text)]
    at = [(i, label) for p, label in PHRASES for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), len(at), min(at, default=(None,))[0], max(at, default=(None,))[0], ",".join(sorted({x for _, x in at}))


def test_notices():
    scanner = ls.Scanner()
    for text, labels in [
        ("Licensed under the Apache License, Version 2.0.", "apache,apache-2.0"),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0"),
        ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-4.0"),
        ("Licensed under a Creative Commons Attribution licence, CC BY 4.0", "cc-by,cc-by-4.0"),
        ("Released under the MIT License. mit\nlicense", "mit,mit-notice"),
        ("Released under the very own new MIT License", "mit"),
        ("an mit licence", ""),
        ("Permission is hereby granted, free of charge, to any person", ""),
    ]:
        got = scanner.scan(text)
        assert got[5] == labels and got[:5] == base(text), text
        assert got[6] == (0.0 if not labels else 0.5 if "-" not in labels.replace("cc-by", "") else 1.0)


@pytest.mark.parametrize("label", ["mit-text", "isc-text", "zlib-text", "bsd-2-clause-text", "bsd-3-clause-text", "apache-2.0-notice", "mpl-2.0"])
def test_a_changed_clause_is_not_accepted(label):
    scanner = ls.Scanner()
    text = re.sub("<<var:[^>]*>>", "the copyright holders", re.sub("<<(optional|end)>>", "", dict(ls.TEMPLATES)[label]))
    words = text.split()
    assert label in scanner.scan("Copyright (c) X. " + text)[5].split(",")
    for at in range(1, len(words) - 1, 7):
        if words[at - 3 : at + 4].count("copyright") or words[at] in "123":
            continue  # near a replaceable or optional region
        changed = " ".join([*words[:at], "not", *words[at:]])
        if not re.search(r"(provided by|shall|is and|name of|http|mozilla) (\w+ ){0,9}not ", changed):
            assert label not in scanner.scan(changed)[5].split(","), changed[:200]
    assert label not in scanner.scan(" ".join(words[:-1]))[5].split(",")


def test_clauses_tell_licenses_apart():
    fill = lambda label: re.sub("<<var:[^>]*>>", "the copyright holder", re.sub("<<(optional|end)>>", "", dict(ls.TEMPLATES)[label]))
    scanner = ls.Scanner()
    assert scanner.scan(fill("bsd-2-clause-text"))[5] == "bsd-2-clause-text"
    assert scanner.scan(fill("bsd-3-clause-text"))[5] == "bsd-3-clause-text"
    assert scanner.scan(fill("gpl-2.0-or-later"))[5] == "gpl,gpl-2.0-or-later"


def test_rows(spark):
    rows = [(1, None), (2, ""), (2, "MIT license MIT license"), (None, "cc by " * 50000), (4, "gnu General\npublic, LICENSE")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as labels")
    got = ls.scan(docs).collect()
    for r in got:
        text = [t for d, t in rows if d == r.doc_id and base(t)[0] == r.n_words][0]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(text)
    assert len(got) == 5 and ls.scan(docs.limit(0)).count() == 0


def test_oracle_agrees(spark):
    import duckdb

    from tracequarry.llm.oracles import license_sql

    texts = ["Licensed under the Apache License, Version 2.0. cc by", "cc BY-nc 4.0; Licensed under a Creative Commons Public CC BY 4.0", "Released under the very MIT license mit license", None, "", "x gnu general public license"]
    whole = [re.sub("<<var:0-2>>", "", re.sub("<<(optional|end)>>", "", t)) for _, t in ls.TEMPLATES]
    texts += [re.sub("<<var:[^>]*>>", "a b", t) for t in whole] + [re.sub("<<var:[^>]*>>", "the x", re.sub("<<optional>>.*?<<end>>", "", t)) for _, t in ls.TEMPLATES]
    rows = list(enumerate(texts))
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    df = ls.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    want = con.execute(f"select {', '.join(df.columns)} from ({license_sql()}) order by doc_id").fetchall()
    assert [tuple(r) for r in df.orderBy("doc_id").collect()] == want
    assert all(r[6] for r in want[6:])
    assert all(label in r[6].split(",") for (label, _), r in zip([*ls.TEMPLATES, *ls.TEMPLATES], want[6:]))
