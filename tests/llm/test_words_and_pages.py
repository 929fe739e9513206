"""Spelling variants, collocations and page text against brute force, SQL and on the odd cases their docstrings define."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from queries.common import star
from tests.oracle import compare, connect
from tidemark.llm import collocations, queries, spelling, webtext

SCHEMA = "doc_id long, text string, lang string, word string, n long, sig long, k int, chunk string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "w", 1, 2, 3, "c") for r in rows], SCHEMA)


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op12_collocations", "op13_html_extraction"])
def test_equals_sql(name, spark, sf):
    assert compare(queries.QUERIES[name](spark, sf), connect(sf), queries.ORACLES[name]) == []


# ------------------------------------------------------------ spelling variants


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long_ = sorted((a, b), key=len)
    return any(long_[:i] + long_[i + 1 :] == short for i in range(len(long_)))


def brute_variants(counts, ratio=2):
    forms, near = {}, {}
    for w, n in counts.items():
        others = [x for x in counts if one_edit(w, x)]
        near[w] = len(others)
        top = min(others, key=lambda x: (-counts[x], x), default=None)
        forms[w] = top if top is not None and counts[top] >= ratio * n else None
    out = {}
    for w in counts:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w] = (forms[w], root, counts[w], near[w], counts.get(forms[w]))
    return out


def collected(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


@pytest.mark.parametrize("groups", [spelling.GROUPS, 4])
def test_variants_equal_all_pairs(spark, groups):
    r = random.Random(4)
    counts = {}
    while len(counts) < 500:  # few letters: many anagrams, chains and ties
        counts["".join(r.choice("abcÀé") for _ in range(r.randint(5, 7)))] = r.choice([3, 3, 4, 6, 7, 12, 14, 30])
    counts |= {"x" * 3000: 5, "x" * 3001: 11, "x" * 2999 + "y": 5, "y" + "x" * 2999: 40}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert collected(spelling.variants(df, groups=groups)) == brute_variants(counts)


def test_equal_signature_for_every_two_places():
    r = random.Random(8)
    for _ in range(200):
        a = [r.choice("abcdefgh") for _ in range(r.randint(5, 12))]
        b = list(a)
        i = r.randrange(len(b))
        b[i : i + 1] = r.choice([[], ["z"], [b[i], "é"]])
        x, y = spelling.signatures(["".join(sorted(a)), "".join(sorted(b))])
        assert (x == y).any()


def test_runs_and_misprints(spark):
    rows = [(None, "Abc déf×Ÿq"), (1, None), (2, ""), (2, "--"), *[(i, f"Word{'x' * (i % 7)} ÀLA\x00dé中fg {i}Abcdefgh") for i in range(300)], (5, "Wordxxxxx")]
    expected = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            expected[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    df = frame(spark, [(d, t, "en") for d, t in rows])
    words = spelling.misprinted(spelling.letter_runs(df))
    assert Counter(r["word"] for r in words.collect()) == expected
    kept = {w: n for w, n in expected.items() if len(w) >= 5 and n >= 3}
    assert {r["word"]: r["n"] for r in spelling.word_counts(words).collect()} == kept
    assert any(zlib.crc32(f"{i}:abcdefgh".encode()) % 97 == 0 for i in range(300))


def test_variants_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    out = spelling.variants(spelling.word_counts(spelling.misprinted(spelling.letter_runs(empty))))
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"] and out.count() == 0


def test_neither_signatures_nor_roots_are_broadcast(spark, monkeypatch):
    """A vector has a signature for each two groups, so the table is far larger than Spark takes it for."""
    plans, write = {}, spelling.materialize
    monkeypatch.setattr(spelling, "materialize", lambda df, label: plans.setdefault(label, []).append(df) or write(df, label))
    df = spark.createDataFrame([("shelter", 40), ("shelte", 9), ("shelt", 4)], "word string, n long")
    out = spelling.variants(df)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10485760b"
    assert collected(out) == {"shelter": (None, "shelter", 40, 1, None), "shelte": ("shelter", "shelter", 9, 2, 40), "shelt": ("shelte", "shelter", 4, 1, 9)}
    plan = lambda x: x._jdf.queryExecution().executedPlan().toString()
    signed, *rounds = plans["spelling-vectors"] + plans["spelling-roots"][1:]
    assert len(rounds) > 0 and all("SortMergeJoin" in plan(x) and "Broadcast" not in plan(x) for x in [signed, *rounds])
    assert "Broadcast" not in plan(out)


# ---------------------------------------------------------------- collocations


def brute_collocations(rows, longest, least, top):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = lang if lang is not None else "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    found = {}
    for (lang, p), a in f.items():
        if len(p) > 1 and a >= least:
            cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found[lang, p] = (a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score)
    covered = {(lang, p[i:j]) for (lang, p), x in found.items() for i in range(len(p)) for j in range(i + 1, len(p) + 1) if j - i < len(p) and 100 * x[0] >= 100 * f[lang, p[i:j]]}
    out = []
    for lang in {x for x, _ in found}:
        mine = [(-x[4], -x[0], " ".join(p).encode(), x) for (l_, p), x in found.items() if l_ == lang and (lang, p) not in covered]
        out += [(lang, i + 1, p.decode(), *x) for i, (_, _, p, x) in enumerate(sorted(mine)[:top])]
    return sorted(out)


@pytest.fixture(scope="module")
def talk(spark):
    r = random.Random(6)
    words = ["a", "b", "C", "ça", "中", "\x00", "d\xa0e", "x\x85"]
    text = lambda n: "".join(r.choice(words) + r.choice([" "] * 8 + ["\t", "  ", ". ", "\n", "\x0b", "!?"]) for _ in range(n))
    rows = [(i, text(r.randint(0, 40)), r.choice(["en", "de", None])) for i in range(60)]
    rows += [(100, None, "en"), (101, "", "fr"), (102, " \t.\n", None), (None, "a b a b a b", None), (103, "z " * 3000, "en")]
    rows += [(104, text(4000), "en")] + [rows[5]] * 7 + [rows[6]] * 7
    return rows, frame(spark, rows)


@pytest.mark.parametrize("longest, least, top, modulus", [(5, 5, 2000, 3), (5, 3, 17, 24), (4, 8, 2000, 1), (2, 5, 2000, 2)])
def test_collocations_equal_brute_force(talk, longest, least, top, modulus):
    rows, df = talk
    found = collocations.collocations(df, longest, least, top, modulus)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == brute_collocations(rows, longest, least, top)


@pytest.mark.parametrize("modulus", [1, 3, 24])
def test_every_word_starts_in_one_chunk(talk, modulus):
    rows, df = talk
    chunks = collocations.dictionary(df, 5, modulus)
    total = chunks.agg(F.sum(F.col("own") * F.col("times"))).first()[0]
    expected = sum(len(re.findall(r"[^\x20\x09]+", p)) for _, t, _ in rows for p in re.split(r"[.,;:!?\x0A-\x0D]", t or ""))
    assert total == expected
    assert chunks.where(F.size(F.split("chunk", " ")) < F.col("own")).count() == 0


def test_repeated_passages_share_chunks(spark):
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    passage = " ".join(word() for _ in range(600))
    df = frame(spark, [(i, " ".join(word() for _ in range(7 * i)) + " " + passage, "en") for i in range(5)])
    times = [r["times"] for r in collocations.dictionary(df).collect()]
    assert sum(t == 5 for t in times) >= 10


def test_scores_past_64_bits(spark):
    counts = spark.createDataFrame([("en", "a", 1, 4 * 10**12), ("en", "b", 1, 3 * 10**12), ("en", "a b", 2, 10**12)], "lang string, phrase string, k int, f long")
    totals = spark.createDataFrame([("en", 10**14 + 7)], "lang string, n long")
    assert [r["score"] for r in collocations.scored(counts, totals).collect()] == [1000 * 10**12 * (10**14 + 7) // (12 * 10**24)]


def test_collocations_of_nothing(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).count() == 0


# ------------------------------------------------------------------- page text

PAGES = "page_id long, url string, html string, text string, n_chars int, host string, row int, salt int, paths string"


def pages(spark, rows):
    return spark.createDataFrame([(i, url, html, "old", 0, "h", 1, 2, "p") for i, (url, html) in enumerate(rows)], PAGES)


def texts(df):
    return {r["page_id"]: r["text"] for r in df.collect()}


class _Article(HTMLParser):
    """Blocks of the article element, read by another parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.on, self.blocks = False, [""]

    def handle_starttag(self, tag, attrs):
        self.on = self.on or tag == "article"
        if tag in ("p", "h1"):
            self.blocks.append("")
        elif tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        self.on = self.on and tag != "article"
        if tag in ("p", "h1", "article"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.on:
            self.blocks[-1] += data


def test_articles_equal_another_parser(spark, sf):
    df = star.table(spark, sf, "pages")
    found = texts(webtext.extract(df))
    for r in df.collect():
        parser = _Article()
        parser.feed(r["html"])
        parser.close()
        assert found[r["page_id"]] == "\n".join(x for x in (" ".join(b.split()) for b in parser.blocks) if x), r["page_id"]


LONG = "Rain fell on the old harbour all night, and the boats stayed in. "


def test_side_parts_leave(spark):
    html = f"""<!doctype html><html><head><title>T &amp; x</title><style>p {{}}</style></head><body class="has-sidebar comments-open">
    <header><h1>Site</h1><nav><ul><li><a href=/>Home</a></ul></nav></header>
    <div class="cookie-notice"><p>We use cookies, {LONG}</p></div>
    <div class="layout-with-sidebar"><main><article class="post-17"><h1>Title &eacute;&#x20AC;&nbsp; x</h1>
    <p>First <b>bold</b>text<br>after&lt;b&gt; <!-- <p>gone --> end.<p>Second <a href="?a>b">link</a> &notanentity; 1 < 2 &am
    <ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table><pre>x\n  y</pre><script>if (a<b) "</p>"</script>
    <form><p>Your mail</p></form><aside>By the way</aside><div class="ad"><p>Buy</p></div>{LONG}
    <section id="comments"><h2>Comments</h2><article class="comment"><p>{LONG * 9}</p></article></section></article></main>
    <div class="sidebar"><p>{LONG}</p></div></div><footer>&copy; x</footer></body></html>"""
    expected = f"Title é€ x\nFirst boldtext after<b> end.\nSecond link &notanentity; 1 < 2 &am\none\ntwo\nc1\nc2\nx y\n{LONG.strip()}"
    expected = expected.replace("&notanentity;", "¬anentity;")  # as browsers read it
    assert texts(webtext.extract(pages(spark, [("http://a.example/1", html)]))) == {0: expected}


def test_the_host_outvotes_a_page(spark):
    """The long notice of one page stands where no class tells it apart; the other pages do."""
    page = lambda i, body, notice: f"<body><div class=top{i}><p>{notice}</p></div><div class='c{i}'><p>{body}</p></div>"
    rows = [(f"http://H.example:80/{i}", page(i, f"Body {i}. " + LONG * 3, "Hello.")) for i in range(12)]
    rows += [("https://h.example/x", page(12, "Short one.", LONG * 20)), ("http://other.example/x", page(1, "Short one.", LONG * 20))]
    rows += [("http://h.example/empty", page(13, "", LONG)), ("http://h.example/odd", f"<div id=z><p>{LONG}</p></div>")]
    found = texts(webtext.extract(pages(spark, rows)))
    assert found[3] == ("Body 3. " + LONG * 3).strip()
    assert found[12] == "Short one." and found[13] == (LONG * 20).strip()
    assert found[14] == "" and found[15] == LONG.strip()


def test_odd_pages(spark):
    deep = "<div>" * 3000 + "<p>" + LONG + "</span>" * 3000
    rows = [(None, None), ("", ""), ("no url", "<p>a</p>"), ("http://a.example/", None), ("http://a.example", "plain &amp; text"), ("http://a.example/2", "<p"),
            ("http://a.example/3", "<article><p>x<p title='it>y</p>"), ("http://b.example", deep), ("http://c.example", "<script>never closed <p>x</p>"),
            (None, "<main><p>" + "word " * 200_000), ("http://d.example", "<!-- <p>x"), ("http://u@E.example?x", "<div role=main>" + LONG + "</div><p>tail")]
    rows += [rows[4]] * 2
    df = pages(spark, rows)
    out = webtext.extract(df)
    assert sorted(out.columns) == sorted(df.columns) and dict(out.dtypes)["n_chars"] == "bigint"
    found = texts(out)
    assert len(found) == len(rows)
    assert [found[i] for i in (0, 1, 2, 3, 4, 5, 8, 10, 12, 13)] == ["", "", "a", "", "plain & text", "", "", "", "plain & text", "plain & text"]
    assert found[6].startswith("x") and found[7] == LONG.strip() and found[9] == ("word " * 200_000).strip() and found[11] == LONG.strip()
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect())
    assert {r["host"] for r in df.select(webtext.host(F.col("url")).alias("host")).collect()} == {"", "a.example", "b.example", "c.example", "d.example", "e.example"}


def test_no_pages(spark):
    out = webtext.extract(spark.createDataFrame([], PAGES))
    assert out.count() == 0 and "text" in out.columns


def test_templates_of_a_host(spark):
    rows = [("h", "a", 50), ("h", "b", 45), ("h", "c", 5), ("g", "c", 1)]
    made = webtext.templates(spark.createDataFrame(rows, "host string, path string, n long")).collect()
    assert {r["host"]: list(r["paths"]) for r in made} == {"h": ["a", "b"], "g": ["c"]}
