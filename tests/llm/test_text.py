"""Language ID, HTML extraction, decontamination, near-dedup and their edges."""

import html
import math
import random
import re
import time
from collections import defaultdict

import numpy as np
import pytest
from conftest_helpers import table
from pyspark.sql import functions as F

from shelfwise.llm import components, decontamination, html_text, language_id, near_dedup, queries

SF, SF2 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_language_id_held_out_accuracy(spark):
    got = queries.op4_language_id(spark, SF2).join(table(spark, SF2, "documents").select("doc_id", "lang"), "doc_id")
    right = got.groupBy("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.min("score"), F.max("score")).collect()
    assert len(right) == 2
    for _, share, low, high in right:
        assert share > 0.97 and 0 <= low <= high <= 1


def brute_language(text, model):
    t = [c if c.isalpha() else "\x01" for c in text.lower()]
    s = ["\x01", *t, "\x01"]
    s = [c for i, c in enumerate(s) if c != "\x01" or i == 0 or s[i - 1] != "\x01"]
    counts = defaultdict(int)
    code = lambda g: sum(ord(c) << (21 * (len(g) - 1 - i)) for i, c in enumerate(g))
    for n in (1, 2, 3):
        for i in range(len(s) - n + 1):
            if s[i : i + n] != ["\x01"]:
                counts[code(s[i : i + n])] += 1
    own = sorted(counts, key=lambda g: (-counts[g], g))[:300]
    away = [sum(min(300, abs(p.index(g) - i)) if g in p else 300 for i, g in enumerate(own)) for _, p in model]
    best = away.index(min(away))
    return model[best][0], 1 - away[best] / (300 * len(own))


def test_language_id_matches_brute_force(spark):
    model = language_id.learn(table(spark, SF, "documents"))
    rows = table(spark, SF, "documents").orderBy("doc_id").limit(12).collect()
    got = {r["doc_id"]: r for r in language_id.identify(table(spark, SF, "documents"), model).collect()}
    for r in rows:
        name, score = brute_language(r["text"][:3000], model) if len(r["text"]) < 3000 else (None, None)
        if name:
            assert got[r["doc_id"]]["lang_pred"] == name and abs(got[r["doc_id"]]["score"] - score) < 1e-9


def test_language_id_edges(spark):
    df = spark.createDataFrame([(1, None, "en", 5), (2, "", "en", 5), (3, "12 !?", "en", 5), (None, "the cat", None, 5), (4, "the cat sat on the mat", "en", 5), (4, "der Hund", "de", 5)], "doc_id long, text string, lang string, score int")
    model = language_id.learn(df)
    assert [m[0] for m in model] == ["de", "en"]
    got = [tuple(r) for r in language_id.identify(df, model).select("doc_id", "lang_pred").collect()]
    assert got == [(1, "und"), (2, "und"), (3, "und"), (None, "en"), (4, "en"), (4, "de")]
    assert language_id.learn(df.limit(0)) == []
    assert language_id.identify(df, []).where("lang_pred <> 'und'").count() == 0
    assert language_id.identify(df.limit(0), model).count() == 0
    held = df.select("doc_id", language_id.held_out(F.col("doc_id"))).distinct().collect()
    import zlib

    assert all(h == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1) for i, h in held)


LONG = "A long paragraph that has enough text to count as the body of a page, and then some more of it. "


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""), ("", ""), ("just text &amp; more", "just text & more"), ("<p>a<", "a"), ("<p>x<!-- <p>no</p> -->y</p>", "xy"),
        ("<nav><ul><li><a href=x>Home</a></ul></nav><article><h1>T</h1><p>b<aside>no</aside><p>c  d\n e</article><footer>f", "T\nb\nc d e"),
        ("<script>var t='<p>no</p>';</script><style>p{}</style><article><p>&lt;b&gt; &copy; &#233;</article>", "<b> © é"),
        (f"<header>Site</header><div>s</div><h1>Head</h1><p>{LONG}</p><p>End.</p><form>Name</form><aside><p>{LONG * 5}</p></aside>", f"Head\n{LONG.strip()}\nEnd."),
        (f"<article><p>{LONG}</p></article><div><p>{LONG * 3}</p></div>", LONG.strip()), (f"<form><div><p>{LONG}</p></div></form>", LONG.strip()),
        (f"<form><nav>menu</nav><article><p>{LONG}</p></article></form>", LONG.strip()), (f"<div role='navigation'>menu</div><p>{LONG}</p><div role=banner>b</div>", LONG.strip()),
        (f"<nav>menu<article><p>{LONG}</p></article>", LONG.strip()),
        ("<p>Short.</p>", "Short."), ("<article><p>a &am</article>", "a &am"), ("<ul><li><a href=1>One</a><li><a href=2>Two</a></ul><p>" + LONG, LONG.strip()),
    ],
)
def test_main_text(page, want):
    assert html_text.main_text(page) == want


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<body class='no-sidebar'><div class='site-footer'>x</div><article><p>{LONG}</p></article></body>", LONG.strip()),
        (f"<div class='content-with-sidebar'><p>Menu</p><article><p>{LONG}</p></article></div>", LONG.strip()),
        (f"<p>Tag line</p><main class='has-sidebar'><p>{LONG}</p></main>", LONG.strip()), (f"<main class=sidebar><p>{LONG}</p></main>", LONG.strip()),
        (f"<body class='logged-in login'><p>{LONG}</p>", LONG.strip()), (f"<div class='social-history'><p>{LONG}</p></div>", LONG.strip()),
        (f"<p>Tag line</p><div class='login'><p>{LONG}</p></div>", f"Tag line\n{LONG.strip()}"),
        (f"<article><p>{LONG}</p><section id='related-work'>R</section><section id=notice>N</section><div class='widget'>W</div></article>", f"{LONG.strip()}\nR\nW"),
        (f"<article class='post category-social'><p>{LONG}</p></article><p>{LONG * 3}</p>", LONG.strip()), ("<article>Short</article><div class=ad>" + LONG[:70] + "</div>", "Short"),
    ],
)
def test_main_text_of_marked_pages(page, want):
    assert html_text.main_text(page) == want


COMMENTS = "".join(f"<div class='comment'><b>Reader {i}</b><p>{LONG}</p></div>" for i in range(60))


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<article><p>{LONG}</p><div class='ad'><p>{LONG * 2}</p></div><p>End.</p><section class=\"comments\">{COMMENTS}</section></article>", f"{LONG.strip()}\nEnd."),
        (f"<div><p>{LONG}</p><p>End.</p></div><div id='comments'>{COMMENTS}</div><div class=sidebar><p>{LONG * 2}</p></div>", f"{LONG.strip()}\nEnd."),
        (f"<main>{LONG[:65]}</main><section id=comments>{COMMENTS}</section>", LONG[:65].strip()), (f"<main>{LONG[:65]}</main><div>{LONG * 60}</div>", LONG[:65].strip()),
        (f"<article><p>{LONG}</p><div class='cookie-notice'>We use cookies</div><p class=ad>Buy</p><li class='comment'>No</li><p>End.</p></article>", f"{LONG.strip()}\nEnd."),
        (f"<article><p>{LONG}</p></article><section class=comments><article><p>{LONG * 9}</p></article></section>", LONG.strip()),
        (f"<article><p>{LONG}</p></article><article class='comment'><p>{LONG * 9}</p></article>", LONG.strip()),
        (f"<div class='left-sidebar'>{LONG}</div><div class='main sidebar-right comments-open'><p>{LONG}</p></div><div class='site-footer'>{LONG}</div>", LONG.strip()),
        (f"<div class=header>{LONG}</div><div><h1>T</h1><p>{LONG}</p></div><div>&copy; 2020 us. {LONG}</div>", f"T\n{LONG.strip()}"),
        (f"<div class=comments><p>{LONG}</p></div>", LONG.strip()), (f"<article><div class='entry-header'><h1>T</h1></div><p>{LONG}</p></article>", f"T\n{LONG.strip()}"),
    ],
)
def test_main_text_without_adverts_notices_and_comments(page, want):
    assert html_text.main_text(page) == want


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<main><h1>Title</h1><p>Intro</p><article><p>{LONG}</p></article></main>", f"Title\nIntro\n{LONG.strip()}"),
        (f"<main><article><p>{LONG}</p></article><article><p>Second part.</p></article><p>End</p></main>", f"{LONG.strip()}\nSecond part.\nEnd"),
        (f"<article><p>{LONG}</p></article><p>between</p><article><p>Other.</p></article>", LONG.strip()),
        ("<article><p>So <math><semantics><mrow><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></mrow><annotation encoding='application/x-tex'>x=\\frac12</annotation></semantics></math> holds.</p></article>", "So x = 1 2 holds."),
    ],
)
def test_main_text_keeps_all_of_the_outermost_article(page, want):
    assert html_text.main_text(page) == want


def test_sums_choose_the_text():
    """Without an article: short lines before the surge go, a run of link lists parts regions, and the one with most text stays."""
    links = "<ul>" + "<li><a href=x>One link</a></li>" * 6 + "</ul>"
    page = f"<p>Tag</p><p>By us</p><p>x</p><p>{LONG}</p><p>Short.</p><p>{LONG}</p>{links}<p>{LONG[:60]}</p>"
    assert html_text.main_text(page) == f"By us\nx\n{LONG.strip()}\nShort.\n{LONG.strip()}"
    assert html_text.main_text(page, surge=1e9).startswith("Tag\nBy us")
    assert html_text.main_text(page, window=1) == f"{LONG.strip()}\nShort.\n{LONG.strip()}"
    assert html_text.main_text(f"<p>{LONG[:60]}</p>{links}<p>{LONG}</p>") == LONG.strip()


@pytest.mark.parametrize("piece", ["<p>a</div>", "<div>", "<b></i>", "<div><nav>x</div>", "<a href=", "<", "<!--", "</div><p>", "<p role="])
def test_malformed_pages_take_linear_time(piece):
    began = time.process_time()
    html_text.main_text(piece * (1_000_000 // len(piece)))
    assert time.process_time() - began < 20


def plain_article(page):
    """An independent reading of pages whose articles hold nothing but h1, p, b and br."""
    inner = page[page.index("<article>") + 9 : page.rindex("</article>")]
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner.replace("<br>", " ")))
    return "\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)


def test_op9_matches_a_plain_reading(spark):
    pages = {r.page_id: r.html for r in table(spark, SF2, "pages").collect()}
    got = {r.page_id: r.text for r in queries.op9_html_extraction(spark, SF2).collect()}
    assert got == {i: plain_article(h) for i, h in pages.items()}
    twice = spark.createDataFrame([(1, None, 5), (1, None, 5), (2, "<p>a</p>", 6)], "page_id long, html string, text long")
    assert [tuple(r) for r in html_text.extract_main_text(twice).select("page_id", "text").collect()] == [(1, ""), (1, ""), (2, "a")]
    assert html_text.extract_main_text(twice.limit(0)).count() == 0


def test_op9(spark):
    got = queries.op9_html_extraction(spark, SF).collect()
    assert all(r.n_chars == len(r.text) and "<p>" not in r.text for r in got) and len(got) == table(spark, SF, "pages").count()


ITEM = "Tom has 3 apples and buys 4 more apples at the market. How many apples does Tom have in total now?"


def test_decontamination(spark, monkeypatch):
    docs = spark.createDataFrame([
        (1, "Before. " + ITEM.replace("Tom", "Ann").replace("3", "70").replace("4", "9") + " After it."),
        (2, ITEM.replace("does Tom", "does Zed")), (3, None), (4, ""), (5, "x " + ITEM.upper()), (None, ITEM), (6, ITEM), (6, ITEM),
        (7, "3 4 5 6 7 8 9 10 11 12 13 14 15 16"), (8, "Nothing of it is here, and all of these words are others, as many as may be."),
        (9, "word " * 3000 + ITEM), (14, ITEM.lower()), (15, ITEM.replace(" ", "\n ")),
    ], "doc_id long, text string")
    items = spark.createDataFrame([(10, ITEM, 1), (10, ITEM, 1), (11, None, 1), (None, ITEM, 1), (12, "too short", 1), (13, "1 2 3 4 5 6 7 8 9 10 11 12", 1)], "item_id long, text string, place int")
    want = [(None, 10, 21, 0), (1, 10, 21, 3), (2, 10, 16, 0), (5, 10, 21, 0), (6, 10, 21, 0), (6, 10, 21, 0), (9, 10, 21, 0), (14, 10, 21, 0), (15, 10, 21, 0)]
    for bits in (decontamination.SIEVE_BITS, 8):  # with 8 bits almost all windows pass
        monkeypatch.setattr(decontamination, "SIEVE_BITS", bits)
        got = sorted((tuple(r) for r in decontamination.contaminated(docs, items).collect()), key=lambda r: (r[0] is not None, r))
        assert got == want
    left = decontamination.without_contaminated(docs.withColumn("place", F.lit(1)), items)
    assert left.columns == ["doc_id", "text", "place"] and sorted(r[0] for r in left.collect()) == [3, 4, 7, 8]
    assert decontamination.contaminated(docs.limit(0), items).count() == decontamination.contaminated(docs, items.limit(0)).count() == 0


CONVERT = "Convert 5 km 300 m to cm and 2 kg 40 g to g"


def test_decontamination_of_numbers_and_short_items(spark, monkeypatch):
    row = "Add 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20 and then give the total"
    other = row.replace(" 20 ", " 77 ").replace(" 3 ", " 88 ")
    docs = spark.createDataFrame([
        (1, "See: " + CONVERT + ". End"), (2, CONVERT.replace("5", "70").replace("40", "9")), (3, row), (4, other), (5, "Rows 1 2 3 4 5 6 7 8 9 10 11 12 13 of it"),
        (6, "He asked: what is 7 plus 8? Nobody knew."), (7, "What is 9 plus 8"), (8, "What is 9 minus 8"), (9, "Add 51 52 53 54 55 56 57 58 59 60 61 62 63 64 65 66 67 68 69 70 to it"),
        (10, "to cm and to g, and 5 km"), (11, "Is it Oslo or Rome?"), (12, "It was 7 plus 8 and what is"),
    ], "doc_id long, text string")
    items = spark.createDataFrame([(1, CONVERT), (2, row), (3, "1 2 3 4 5 6 7 8 9 10 11 12"), (4, "What is 7 plus 8?"), (5, "oslo or rome"), (6, "")], "item_id long, text string")
    want = [(1, 1, 14, 0), (2, 1, 14, 2), (3, 2, 26, 0), (3, 3, 12, 0), (4, 2, 26, 2), (5, 2, 13, 0), (5, 3, 12, 0), (6, 4, 5, 0), (7, 4, 5, 1), (11, 5, 3, 0)]
    for bits in (decontamination.SIEVE_BITS, 8):
        monkeypatch.setattr(decontamination, "SIEVE_BITS", bits)
        assert sorted(tuple(r) for r in decontamination.contaminated(docs, items).collect()) == want


def test_op3_finds_what_plain_search_does(spark):
    words = lambda t: " ".join("".join(c if c.isalnum() else " " for c in (t or "").lower()).split())
    docs = [(r.doc_id, words(r.text)) for r in table(spark, SF2, "documents").collect()]
    items = [(r.item_id, words(r.text)) for r in table(spark, SF2, "benchmark").collect()]
    want = {(d, i) for d, t in docs for i, x in items if f" {x} " in f" {t} "}
    assert {(r.doc_id, r.item_id) for r in queries.op3_decontamination(spark, SF2).collect()} == want and want


def holds(doc, item, width=8, run=12):
    """Whether a document holds an item, by trying each shift and each run of places."""
    (d, dv), (i, iv) = [(decontamination.codes([t])[0], decontamination.values(t)) for t in (doc, item)]
    w, low = min(width, len(i)), decontamination.MEASURE
    read = list(zip(decontamination.readings(d), decontamination.readings(i), strict=True)) if w else []
    for shift in range(w - len(i), len(d) - w + 1):
        at = {}
        for q in range(max(0, -shift), min(len(i) - w, len(d) - w - shift) + 1):
            p = q + shift
            for k, (a, b) in enumerate(read):
                x, y = a[p : p + w].tolist(), b[q : q + w].tolist()
                if x != y or k < 2 and (w < 4 or max(y) <= low):
                    continue
                free = [j for j in range(w) if y[j] <= low]
                for j in range(w):
                    at.setdefault(q + j, None)
                held = [q + j for j in free]
                step = 1 if free == list(range(1, w)) else -1 if free == list(range(w - 1)) else 0
                j = q + w if step == 1 else q - 1
                while step and 0 <= j < len(i) and 0 <= j + shift < len(d) and b[j] <= low and a[j + shift] == b[j]:
                    held.append(j)
                    j += step
                at |= {j: (iv[j], dv[j + shift]) for j in held}
        for s in at:
            slots, same, e = {}, 0, s
            while e in at and (at[e] is None or slots.setdefault(*at[e]) == at[e][1]):
                same += at[e] is None or at[e][0] == at[e][1]
                e += 1
                if e - s >= min(run, len(i)) and same >= min(width // 2, len(i)):
                    return True
    return False


def templates(rng, count):
    """Texts of a few passages that they share, with numbers, units, names and words drawn anew."""
    passages = ["please answer the question that now follows with care", "one of A B C or D is right so choose", "NUM NUM NUM NUM NUM NUM NUM total NUM NUM NUM NUM NUM",
                "NAME has NUM km of rope and NAME has NUM km more", "how many are left when NAME gives NUM of them to NAME", "NUM UNIT and NUM UNIT"]
    draw = {"NUM": lambda: str(rng.randrange(2, 6)), "NAME": lambda: rng.choice(["Ann", "Bob", "Cy"]), "UNIT": lambda: rng.choice(["kg", "cm"])}
    word = lambda: rng.choice("red blue green old new big small".split())
    out = []
    for _ in range(count):
        parts = [" ".join(draw.get(x, lambda x=x: x)() for x in rng.choice(passages).split()) for _ in range(rng.randrange(1, 4))]
        out.append(" ".join(f"{p} {' '.join(word() for _ in range(rng.randrange(4)))}" for p in parts).strip())
    return out


def test_op3_matches_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    docs, items = list(enumerate(templates(rng, 150))), list(enumerate(templates(rng, 60)))
    want = {(d, i) for d, t in docs for i, x in items if holds(t, x)}
    assert 100 < len(want) < 6000
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    rows = []
    for common in (0, decontamination.COMMON, 10**9):  # all windows common, some, none
        monkeypatch.setattr(decontamination, "COMMON", common)
        rows.append(sorted(tuple(r) for r in decontamination.contaminated(docs, items).collect()))
        assert {r[:2] for r in rows[-1]} == want
    assert rows[0] == rows[1] == rows[2]


def test_common_windows_name_no_pairs(spark):
    """A window in all documents and 200 items, but one item in one document."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    own = lambda side, k: " ".join(f"{side}{chr(97 + k // 26 % 26)}{chr(97 + k % 26)}{x}" for x in words)
    shared = " choose the one best answer to what is asked "  # nine tokens: two windows, and no run
    items = [(k, own("q", k) + shared + own("r", k)) for k in range(200)]
    docs = [(k, own("d", k) + shared + own("e", k)) for k in range(600)] + [(1000, "so " + items[7][1])]
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert [tuple(r)[:2] for r in decontamination.contaminated(docs, items).collect()] == [(1000, 7)]
    windows = decontamination._windows(items, 8).distinct()
    sieve = decontamination._sieve(windows)
    find = lambda batches: decontamination._hits(8, [], 0, sieve)(batches)
    found = docs.selectExpr("doc_id as place", "cast(doc_id as string) as doc", "text").mapInPandas(find, f"place long, doc string, p long, h long, {decontamination._SLOTS}")
    assert found.join(windows.select("h"), "h").count() > 200 * 600
    assert decontamination._matches(found, windows, 8, 12).count() < 100


def brute_groups(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    inverted, first = defaultdict(list), {}
    for i, s in enumerate(sets):
        if not s:
            continue
        near = {first[s]} if s in first else {j for x in s for j in inverted[x]}
        for j in near:
            common = len(s & sets[j])
            if 100 * common >= 75 * (len(s) + len(sets[j]) - common):
                parent[find(i)] = find(j)
        if s not in first:
            first[s] = i
            for x in s:
                inverted[x].append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def compare_groups(spark, given):
    df = spark.createDataFrame([(*g, 1, "k") for g in given], "doc_id long, text string, n int, kept string").repartition(3)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df).collect()), key=str)
    assert got == sorted(brute_groups(given), key=str)


def edited(rng, words, share):
    return [rng.choice("abcdefgh") + str(rng.randrange(10**6)) if rng.random() < share else w for w in words]


def test_near_dedup_matches_brute_force(spark):
    rng = random.Random(11)
    given, passage = [], [f"p{i}" for i in range(60)]
    for g in range(60):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([3, 4, 5, 6, 8, 12, 30, 100, 165, 200, 230, 700]))]
        for c in range(rng.randrange(1, 7)):
            given.append((len(given), " ".join(edited(rng, base, rng.choice([0, 0, 0.01, 0.03, 0.06])))))
        for _ in range(2):
            given.append((len(given), " ".join(passage + [f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(10, 80))])))
    hub = [f"h{i}" for i in range(400)]
    given += [(len(given) + i, " ".join(edited(rng, hub, 0.03))) for i in range(40)] + [(5000, " ".join(hub))]
    compare_groups(spark, given)


def test_near_dedup_edges(spark):
    text = "a b c d e f g h i j k l"
    given = [(9, text), (3, text.upper()), (None, text), (None, "solo one two three four five"), (5, None), (6, ""), (7, " \t\n"), (8, "one"), (4, "ONE"), (3, text), (10, "é É a b c d"), (11, "é é a b c d")]
    compare_groups(spark, given)
    kept = near_dedup.without_near_duplicates(spark.createDataFrame([(*g, 1) for g in given], "doc_id long, text string, place int"))
    assert kept.columns == ["doc_id", "text", "place"]
    assert sorted(map(str, (r[0] for r in kept.collect()))) == sorted(map(str, [3, None, 5, 6, 7, 4, 10, 11]))
    assert near_dedup.near_duplicates(kept.limit(0)).count() == 0


def test_blocks_of_large_groups(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 5)
    rng = random.Random(2)
    base = [f"w{i}" for i in range(300)]
    compare_groups(spark, [(i, " ".join(edited(rng, base, 0.02))) for i in range(30)])


def test_parts_of_large_groups(spark, monkeypatch):
    """Copies on both sides of the threshold: forests fail, and pairs between and within blocks join what links."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    given = [(i, " ".join(edited(rng, base, rng.choice([0.005, 0.02, 0.03, 0.05])))) for i in range(70)]
    assert len({c for _, _, c in brute_groups(given)}) > 5
    compare_groups(spark, given)
    monkeypatch.setattr(near_dedup, "BLOCK", 6)
    compare_groups(spark, given)
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 400)
    compare_groups(spark, given)


def test_registers_estimate_jaccard():
    rng = np.random.default_rng(1)
    for share in (0.3, 0.75, 0.95):
        a = rng.integers(0, 2**63, 4000).astype(np.uint64)
        b = np.unique(np.concatenate((a[: int(len(a) * 2 * share / (1 + share))], rng.integers(0, 2**63, len(a) - int(len(a) * 2 * share / (1 + share))).astype(np.uint64))))
        x, y = near_dedup.registers(np.unique(a)).ravel(), near_dedup.registers(b).ravel()
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs(near_dedup.estimates(x, y[None], near_dedup.chance(4000))[0] - true) < 4 * math.sqrt(true * (1 - true) / 160) + 0.01


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(90), rng.randrange(90)) for _ in range(60)] + [(5, 5), (7, 8), (8, 7)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def template_group(n, seed=3):
    """Members of one band: n documents of one template, most of whose pairs are just under a similarity of 0.75."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(300)]
    sets = []
    for i in range(n):
        words = list(base)
        for at in rng.choice(300, 6 + i % 3, replace=False):
            words[at] = f"x{rng.integers(10**9)}"
        sets.append(next(near_dedup.shingles([" ".join(words)])))
    sets.sort(key=len)
    sizes = np.array([len(x) for x in sets])
    regs = np.array([near_dedup.registers(x).ravel() for x in sets])
    regs[:, : near_dedup.ROUNDS] = regs[0, : near_dedup.ROUNDS]  # they share the first band
    info = np.array([np.arange(n), np.arange(n), sizes, np.zeros(n, np.int64), np.zeros(n, np.int64)])
    return (1, 0, 0), info, regs, sets


def test_hot_bands_are_counted_not_compared_one_by_one():
    group = template_group(150)
    links = near_dedup._joined(group, 75)
    assert links == near_dedup._joined(group, 75, -1)
    linked = [(i, j) for i in range(150) for j in range(i) if near_dedup.linked(group[3][i], group[3][j], 75)]
    above = list(range(150))

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for i, j in linked:
        above[max(top(i), top(j))] = min(top(i), top(j))
    assert linked and len(links) == 150 - len({top(i) for i in range(150)})
    assert all(near_dedup.linked(group[3][a], group[3][b], 75) for a, b in links)
    common = near_dedup.Common(group[3])
    for others in (np.array([3]), np.arange(1, 150), np.array([149, 2, 77])):
        assert common.counts(0, others).tolist() == [len(np.intersect1d(group[3][0], group[3][i])) for i in others]
    began = time.process_time()
    near_dedup._joined(template_group(1500), 75)
    assert time.process_time() - began < 60  # 1.1 million pairs


def test_cut_can_be_turned_off(spark):
    """With least = -1 every pair that meets is compared: the result is the same."""
    docs = table(spark, SF, "documents").select("doc_id", "text")
    cut = {tuple(r) for r in near_dedup.near_duplicates(docs).collect()}
    assert cut == {tuple(r) for r in near_dedup.near_duplicates(docs, least=-1.0).collect()}


def test_no_text_moves_where_few_rows_hold_an_item(spark, monkeypatch):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    docs = spark.createDataFrame([(1, f"so {item} it goes"), (2, "nothing of the kind"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where a table's size isn't known
    for most, joined in ((1 << 20, "BroadcastHashJoin"), (0, "SortMergeJoin")):
        monkeypatch.setattr(decontamination, "SENT", most)
        left = decontamination.without_contaminated(docs, items)
        assert joined in left._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.doc_id for r in left.collect()) == [2, 3]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
