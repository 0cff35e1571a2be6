"""HTML region, filter audit and ranked search against brute force on whole small tables, and edge cases."""

import html
import math
import re
import sys
import time
from collections import Counter
from itertools import permutations
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import __spark_entry__ as entry  # noqa: E402
from tallywise.llm import filter_audit, html_region, rmq_search  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = "documents labels benchmark pages"


def with_sql(name, sf=SF):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    got = con.execute(entry.oracle_sql()[name])
    return [d[0] for d in got.description], got.fetchall()


@pytest.mark.parametrize("name", ["op12_filter_audit", "op13_rmq_search"])
def test_equals_sql(spark, name):
    got = entry.queries()[name](spark, SF)
    columns, want = with_sql(name)
    assert got.columns == columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


# ---------------------------------------------------------------- 11 pages

def article(page):
    inside = re.search("<article>(.*?)</article>", page, re.S)[1]
    return " ".join(html.unescape(re.sub("<[^>]*>", " ", inside)).split())


def test_pages_give_their_articles(spark):
    rows = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = entry.queries()["op11_html_region"](spark, SF)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    got = got.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.text == article(rows[r.page_id].html) and r.n_chars == len(r.text) and r.url == rows[r.page_id].url


@pytest.fixture(scope="module")
def weights(spark):
    return html_region.learn_weights(spark.read.parquet(f"{SF}/pages.parquet"))


FRAME = ('<html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body><header><h2>Site of ours</h2></header>'
         '<nav><a href="/">Start here</a></nav><div id="cookie-consent"><p>We use cookies on these pages, as all do.</p></div>%s'
         '<section class="comments-area"><h3>Comments</h3><article class="comment"><p>I read all of this, and liked it very much.</p>'
         '</article></section><aside><p>Read also the other page of ours, it is as good.</p></aside>'
         '<form><label>Your name</label><textarea>write</textarea></form><footer>All rights</footer></body></html>')
TEXT = ('<h1>On &amp; off</h1><p>First  words\n of it, <a href="/x">linked</a> ones too.</p><div class="ad">Buy now, cheap and good</div>'
        '<ul><li>one<li>two</ul><p>La<b>st</b> wo&#114;ds&nbsp;here, a &lt; b.<br>End')
WANT = "On & off First words of it, linked ones too. one two Last words here, a < b. End"


@pytest.mark.parametrize("around", ["<article>%s</article>", "<main>%s</main>", '<div class="x">%s</div>', "<main><div>Skip</div><article>%s</article></main>",
                                    '<article><header class="entry-header">%s</article>', '<div class="page has-sidebar"><article>%s</article></div>'])
def test_region_of_varied_pages(weights, around):
    assert html_region.main_text(FRAME % (around % TEXT), weights) == WANT


def test_pages_without_a_region(spark, weights):
    for page in ("", " \n", "<!-- only a note", "<nav><a>Menu</a></nav>", "<script>if (a < b) c();</script>", "<p", "<div><a href='x'>Go</a></div>"):
        assert html_region.main_text(page, weights) == ""
    assert html_region.main_text("<p>plain words only, left open", weights) == "plain words only, left open"
    assert html_region.main_text("<nav><a>left open</a><main><p>the words of it</p></main>", weights) == "the words of it"


def test_broken_pages_take_linear_time(weights):
    begun = time.time()
    for page in ("<" * 400_000, "<a " * 200_000, '<p title="' * 60_000, "<div>" * 200_000 + "</b>" * 200_000, "<!--" * 200_000,
                 "<b>" * 100_000 + "<p>x</p>" * 50_000, "<nav><main>" * 60_000, "<p><b><br>" * 60_000 + "word", "&" * 300_000):
        html_region.main_text(page, weights)
    long = "<article><p>" + "word " * 500_000 + "</p></article>"
    assert html_region.main_text(long, weights) == ("word " * 500_000).strip()
    assert time.time() - begun < 60


def test_page_table_edges(spark):
    schema = "page_id long, url string, html string, TEXT string, n_chars int"
    rows = [(1, "u", None, "own", 7), (1, "u", None, "own", 7), (None, None, "<article><p>Words of it</p></article>", None, None)]
    got = html_region.with_main_text(spark.createDataFrame(rows, schema))
    assert got.columns == ["page_id", "url", "html", "TEXT", "n_chars", "_text", "_n_chars"]
    assert sorted((r["_text"], r["_n_chars"], r["TEXT"] or "") for r in got.collect()) == [("", 0, "own")] * 2 + [("Words of it", 11, "")]
    assert html_region.with_main_text(spark.createDataFrame([], schema)).count() == 0


def test_best_run_is_the_best():
    import random
    draw = random.Random(3)
    for _ in range(300):
        s = [draw.choice([-3, -1, -0.5, 0, 0.5, 1, 2]) for _ in range(draw.randrange(0, 12))]
        sums = {(a, b): sum(s[a:b]) for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
        top = max(sums.values(), default=0)
        a, b = html_region.best_run(s)
        assert sum(s[a:b]) == max(top, 0) and (top > 0) == (b > a)


# ---------------------------------------------------------------- 12 audit

def audit_by_hand(docs, labels):
    ids = {}
    for d in docs:
        if d[0] is not None:
            t = d[1] or ""
            ids[t] = min(ids.get(t, d[0]), d[0])
    good = {x[0] for x in labels if x[1] == 1 and x[0] is not None}
    toxic = {x[0] for x in labels if x[2] == 1 and x[0] is not None}
    rows = []
    for doc_id, text, source in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 "D": bool(re.search("[#$%&*|]", t)), "E": doc_id is not None and t in ids and doc_id > ids[t]}
        rows.append((source or "", fails, doc_id in good, doc_id in toxic))
    out, blame = {}, Counter()
    for part in {r[0] for r in rows}:
        for order in permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                here = [r for r in left if r[1][f]]
                out[part, "".join(order), step] = (len(left) - len(here), len(here), sum(r[1][f] for r in gone),
                                                   sum(r[1][f] and sum(r[1].values()) == 1 for r in rows if r[0] == part),
                                                   sum(r[2] for r in here), sum(r[3] for r in here), f)
                blame[part, f] += len(here)
                left, gone = [r for r in left if not r[1][f]], gone + here
    return {k: v[:6] + (blame[k[0], v[6]],) for k, v in out.items()}


def test_audit_edges(spark):
    text = "eine Zeile mit Wort und noch mehr " * 9
    docs = [(1, None, None), (2, "", ""), (None, "", "a"), (4, text, "a"), (4, text, "a"), (9, text, "b"), (None, text, "b"), (7, "A" * 60_000, "b"),
            (8, "x# " * 30_000, None), (10, " ".join(f"w{i}" for i in range(60)), "b"), (11, "Ä\x1c  ü" * 60, "a")]
    labels = [(4, 1, 0), (4, 0, 1), (9, 1, None), (None, 1, 1), (10, 0, 0), (7, None, 1)]
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, source string, mask string, n int")
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {tuple(r)[:3]: tuple(r)[3:] for r in filter_audit.audit(frame, told).collect()}
    assert got == audit_by_hand(docs, labels)
    assert filter_audit.audit(frame.limit(0), told).count() == 0


# --------------------------------------------------------------- 13 search

def ranked_by_hand(docs, items):
    def terms(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return Counter(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low))

    held = [(d, terms(t)) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n, length = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in set(items):
        scored = []
        for d, c in held:
            m = 75 + 25 * c.total() * n // length
            s = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                    for t, times in terms(text).items() if t in c)
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out += [(item_id, k, None if x[1] else x[2], -x[0]) for k, x in enumerate(sorted(scored)[:20], 1)]
    return sorted(out, key=str)


def test_search_edges(spark, monkeypatch):
    docs = [(i % 35, f"alpha {'beta ' * (i % 5)} g{i % 3} ÄÖ-x") for i in range(200)]
    docs += [(None, "alpha delta"), (None, "alpha delta"), (-5, "alpha delta"), (3, None), (4, ""), (5, ".,-"), (6, "delta " * 400_000)]
    items = [(1, "Alpha beta-BETA g1"), (2, "delta"), (2, "delta"), (None, "äö ÄÖ x"), (7, None), (8, "?"), (9, "nowhere"), (10, "")]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, rank int")
    asked = spark.createDataFrame(items, "item_id long, text string")
    want = ranked_by_hand(docs, [(i, t) for i, t in items if t])
    assert sorted(map(tuple, rmq_search.rank_documents(frame, asked).collect()), key=str) == want
    monkeypatch.setattr(rmq_search, "ITEM_BYTES", 8)  # several groups of items
    assert sorted(map(tuple, rmq_search.rank_documents(frame, asked).collect()), key=str) == want
    for d, i in ((frame.limit(0), asked), (frame, asked.limit(0))):
        assert rmq_search.rank_documents(d, i).count() == 0


def test_small_blocks_give_the_same_ranking(spark, monkeypatch):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    asked = [(i, rmq_search.term_counts(t)) for i, t in items]
    terms = sorted({t for _, c in asked for t in c})
    block, rows = rmq_search._Block({t: n for n, t in enumerate(terms)}), []
    for doc_id, text in docs:
        block.add(doc_id, text)
        if len(block.docs) == 16:
            rows.append(block.row([t.decode() for t in terms]))
            block = rmq_search._Block(block.vocabulary)
    rows.append(block.row([t.decode() for t in terms]))
    n, length = sum(r["n_docs"] for r in rows), sum(r["n_terms"] for r in rows)
    df = Counter()
    for r in rows:
        df.update(dict(zip(r["terms"], map(int, r["dfs"]))))
    weights = {t: rmq_search.weight(n, k) for t, k in df.items()}
    got = []
    blocks = [rmq_search.SearchBlock(*(r[c] for c in ("doc_ids", "lengths", "terms", "dfs", "places", "counts")), weights, n, length)
              for r in rows if len(r["places"])]
    for item_id, held in asked:
        best = rmq_search.Best()
        for b in blocks:
            b.search([(t.decode(), k) for t, k in held.items()], best)
        got += [(item_id, k, int(d), int(s)) for k, (s, d) in enumerate(zip(best.scores, best.ids), 1)]
    assert sorted(got, key=str) == ranked_by_hand(docs, items)
