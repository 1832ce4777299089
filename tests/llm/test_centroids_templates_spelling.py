"""Centroid clustering, main text extraction and spelling variants: brute force, odd rows, many layouts."""

import hashlib
import itertools
import math
import random
import time
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from tiltwatch.llm import centroids, spelling, templates

NAN, INF = float("nan"), float("inf")


# --- centroids -----------------------------------------------------------------------------


def brute_kmeans(rows, k, dims, rounds, seed=2):
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, [math.floor(256 * x) for x in v]))

    def key(row):
        return (row[0] is None, hashlib.sha256(f"{seed}:{row[0]}".encode()).hexdigest(), row[1])

    centres = [v for _, v in sorted(kept, key=key)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centres))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        for i, group in members.items():
            centres[i] = [sum(c) // len(group) for c in zip(*group)]
    return sorted((str(i), nearest(v)[1], nearest(v)[0]) for i, v in kept), centres


@pytest.mark.parametrize("seed", range(20))
def test_orchard_finds_the_first_nearest(seed):
    r = np.random.default_rng(seed)
    centres = r.integers(-3, 4, (r.integers(1, 41), r.integers(1, 5)))  # many equal centroids and ties
    queries = r.integers(-4, 5, (300, centres.shape[1]))
    apart = ((queries[:, None] - centres[None]) ** 2).sum(-1)
    at, far = centroids.Orchard(centres).nearest(queries)
    assert (at == apart.argmin(1)).all() and (far == apart.min(1)).all()


def test_orchard_at_the_limit():
    top = centroids.LIMIT
    centres = np.array([[top] * 64, [-top] * 64, [0] * 64])
    at, far = centroids.Orchard(centres).nearest(np.array([[top] * 64, [-top] * 64, [1] * 64]))
    assert at.tolist() == [0, 1, 2] and far.tolist() == [0, 0, 64]


def test_orchard_measures_fewer_than_all():
    r = np.random.default_rng(1)
    centres = r.integers(-10_000, 10_000, (60, 2))
    search, measured = centroids.Orchard(centres), []
    distance = search._distance
    search._distance = lambda q, w: measured.append(len(q)) or distance(q, w)
    search.nearest(centres[r.integers(0, 60, 2000)] + r.integers(-50, 50, (2000, 2)))
    assert sum(measured) < 0.5 * 2000 * 60


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster string, distance string, v int")


def test_clusters_as_brute_force(spark):
    r = random.Random(3)
    rows = [(i, [r.choice([-1, 0, 1]) + r.random() / 8 for _ in range(4)]) for i in range(300)]
    rows += rows[:20] + [(7, rows[0][1])] * 100  # repeated rows, one vector a quarter of all
    rows += [
        (900, None), (901, []), (902, [1.0, None, 0.0, 0.0]), (903, [NAN, 0.0, 0.0, 0.0]), (904, [0.0, INF, 0.0, 0.0]),
        (905, [1.0] * 5), (None, [0.5, 0.5, 0.5, 0.5]), (906, [-0.0001, 0.0, 1e-300, -1e-300]),
    ]
    want, centres = brute_kmeans(rows, 9, 4, 3)
    found, final = centroids.cluster(_vectors(spark, [(i, v, "x", "y", 1) for i, v in rows]), 9, 4, rounds=3)
    with_sums = centroids.with_inertia(found).collect()
    assert sorted((str(x["vec_id"]), x["cluster"], x["distance"]) for x in with_sums) == want
    assert final.tolist() == centres
    per = Counter()
    for _, c, d in want:
        per[c] += d
    assert all(x["cluster_inertia"] == per[x["cluster"]] and x["inertia"] == sum(per.values()) for x in with_sums)


def test_few_or_no_vectors(spark):
    found, final = centroids.cluster(_vectors(spark, [(1, [0.5, 1.0], "", "", 0)]), 40, 2)
    assert [tuple(r) for r in found.collect()] == [(1, 0, 0)] and final.tolist() == [[128, 256]]
    found, final = centroids.cluster(_vectors(spark, [(1, None, "", "", 0)]), 40, 2)
    assert centroids.with_inertia(found).collect() == [] and len(final) == 0


def test_components_beyond_the_limit_count_as_it(spark):
    rows = centroids.integer_vectors(_vectors(spark, [(1, [1e300, -1e300], "", "", 0)]), 2).collect()
    assert rows[0]["v"] == [centroids.LIMIT, -centroids.LIMIT]


# --- spelling ------------------------------------------------------------------------------


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def brute_variants(counts):
    out = {}
    for w, n in counts.items():
        close = [x for x in counts if near(w, x)]
        best = min(close, key=lambda x: (-counts[x], x), default=None)
        out[w] = (n, len(close), best if best is not None and counts[best] >= 10 * n else None)
    rows = set()
    for w, (n, k, form) in out.items():
        root = w
        while out[root][2] is not None:
            root = out[root][2]
        rows.add((w, n, k, form, counts[form] if form else None, root))
    return rows


def _words(seed, n, letters="abéx"):
    r, found = random.Random(seed), set()
    while len(found) < n:
        w = "".join(r.choice(letters) for _ in range(r.randint(4, 9)))
        i = r.randrange(len(w))
        found |= {x for x in (w, w[:i] + w[i + 1 :], w[:i] + "a" + w[i:], w[:i] + "b" + w[i + 1 :]) if len(x) >= 4}
    return sorted(found)


def test_variants_as_brute_force(spark):
    r = random.Random(1)
    words = _words(1, 700) + ["a" * 3000, "a" * 2999, "a" * 2998 + "b" + "a"]
    counts = {w: r.choice([1, 2, 3, 19, 20, 200, 4000, 50_000]) for w in words}
    rows = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = [tuple(x) for x in spelling.variants(rows).select("word", "n", "n_near", "form", "form_n", "root").collect()]
    want = brute_variants(counts)
    assert len(found) == len(want) and set(found) == want
    chains = {w: f for w, _, _, f, _, root in want if f}
    assert any(chains.get(chains[w]) for w in chains)  # some words lead over more than one form


def test_no_near_word_is_lost_among_common_grams(spark):
    # Every word shares the same few grams: prefixes tie, lists are long, no link may go.
    words = ["".join(p) for p in itertools.product("ab", repeat=7)]
    rows = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    found = {tuple(x) for x in spelling.near_pairs(rows).select("a", "b").collect()}
    assert found == {(a, b) for a, b in itertools.combinations(words, 2) if near(a, b)}


def test_pivots_are_disjoint_and_cheapest():
    r = random.Random(5)
    for _ in range(300):
        positions = sorted(r.sample(range(12), r.randint(3, 7)))
        costs = [r.randint(0, 9) for _ in positions]
        got = spelling.pivots(positions, costs)
        cost = dict(zip(positions, costs))
        assert got[1] - got[0] >= 2
        assert sum(cost[p] for p in got) == min(
            cost[a] + cost[b] for a, b in itertools.combinations(positions, 2) if b - a >= 2
        )


def test_postings_share_a_key_for_every_edit():
    r = random.Random(9)
    words = _words(9, 300, "abc")
    grams = Counter(w[i : i + 2] for w in words for i in range(len(w) - 1))
    ranks = {g: i for i, (_, g) in enumerate(sorted((n, g) for g, n in grams.items()))}
    for a, b in itertools.combinations(words, 2):
        if near(a, b):
            (ai, asearch, alast), (bi, bsearch, blast) = spelling.postings(a, ranks), spelling.postings(b, ranks)
            assert (alast <= blast and set(asearch) & set(bi)) or (blast <= alast and set(bsearch) & set(ai)), (a, b)
    assert r


def test_long_word_is_linear():
    word = "ab" * 20_000
    start = time.time()
    spelling.postings(word, {"ab": 0, "ba": 1})
    assert time.time() - start < 5


def test_vocabulary_of_odd_texts(spark):
    texts = [
        (1, "Schlüssel schlüssel SCHLÜSSEL schlÜssel", "x"), (1, "Schlüssel schlüssel SCHLÜSSEL schlÜssel", "x"),
        (2, None, "x"), (3, "", "x"), (None, "nothing nothing", "x"), (4, "kürzer kürzer abc×def÷ghi abc×def÷ghi", "x"),
        (5, "wörter1wörter2 überall-überall", "x"), (6, "x" * 100_000 + " " + "x" * 100_000, "x"),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string, word string")
    counts = Counter()
    for doc_id, text, _ in texts:
        for run in "".join(c if c.isascii() and c.isalpha() or "À" <= c <= "ÿ" else " " for c in text or "").split():
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 3 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 7
    found = spelling.vocabulary(docs, noise=spelling.drop_by_checksum(3)).collect()
    assert {(r["word"], r["n"]) for r in found} == {(w, n) for w, n in counts.items() if n >= 2}
    assert len(found) == len({r["word"] for r in found})


def test_no_words(spark):
    empty = spark.createDataFrame([], "word string, n long")
    assert spelling.variants(empty).collect() == []
    one = spark.createDataFrame([("einzeln", 4)], "word string, n long")
    assert [tuple(r) for r in spelling.variants(one).select("word", "n_near", "form", "root").collect()] == [
        ("einzeln", 0, None, "einzeln")
    ]


# --- main text -----------------------------------------------------------------------------

WORDS = "river stone winter harbour letter window garden silver morning engine copper valley market bridge".split()


def prose(r, n):
    return " ".join(r.choice(WORDS) for _ in range(n)).capitalize() + f" {r.randint(0, 10**9)}."


def news(r, i, title, body):
    """Semantic elements, a notice, an advert, comments, a form."""
    comments = "".join(f'<li class="comment"><b>user{j}</b><p>{prose(r, 30)}</p><a href="#">Reply</a></li>' for j in range(r.randint(0, 4)))
    return (
        f'<html><head><title>{title}</title><script>if (a < b) document.write("<p>no</p>")</script></head><body>'
        f'<header><h2>Daily News</h2><p>Since 1890</p></header><nav><a href="/">Home</a> <a href="/x">{prose(r, 2)}</a></nav>'
        f'<div id="cookie-notice"><p>We use cookies to make this site work. {prose(r, 20)}</p></div>'
        f"<main><article><h1>{title}</h1>{''.join(f'<p>{p}</p>' for p in body)}"
        f'<div class="share-buttons"><a>Tweet</a></div></article><ol class="comments">{comments}</ol></main>'
        f'<aside><h3>More</h3><p>{prose(r, 60)}</p></aside><form><p>Subscribe</p><input></form>'
        f"<footer>&copy; {prose(r, 5)}</footer></body></html>"
    )


def plain(r, i, title, body):
    """No telling element or name at all: only the slots tell."""
    menu = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in WORDS[:8])
    return (
        f'<html><body><div class="k1"><div class="k2"><ul>{menu}</ul></div><div class="k3">Harbour Gazette, printed daily</div></div>'
        f'<div class="k4"><div class="k5"><h1>{title}</h1>{"".join(f"<p>{p}</p>" for p in body)}'
        f"<p>Copyright of the Harbour Gazette, all rights reserved.</p></div>"
        f'<div class="k6"><p>You might like</p><ul>{"".join(f"<li><a>{prose(r, 4)}</a></li>" for _ in range(4))}</ul></div></div>'
        f'<div class="k7">Harbour Gazette, 1 Quay Road</div></body></html>'
    )


def forum(r, i, title, body):
    """Tables as layout, unclosed paragraphs and cells, a list inside the text."""
    return (
        f'<table><tr><td class="left"><a href=1>Start</a><br><a href=2>Search</a><br><a href=3>Members</a>'
        f'<td class="mid"><h1>{title}</h1>{"".join(f"<p>{p}" for p in body)}'
        f'<td class="right"><div class="ad">{prose(r, 8)}</div></table><div class="footer">{prose(r, 9)}</div>'
    )


@pytest.mark.parametrize("layout", [news, plain, forum])
@pytest.mark.parametrize("shift", [0, 1])
def test_layouts_of_a_host(spark, layout, shift):
    r = random.Random(shift)
    rows, want = [], {}
    for i in range(30):
        title = prose(r, 4)
        body = [prose(r, r.randint(15, 80)) for _ in range(r.randint(2, 8))]
        rows.append((i, f"http://{layout.__name__}.example.org/{i}", layout(r, i, title, body), "a", "b"))
        want[i] = "\n".join([title, *body])
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, template string")
    found = {x["page_id"]: x["text"] for x in templates.extract(pages).collect()}
    assert found == want


def test_hosts_side_by_side_and_copies(spark):
    """Layouts of different hosts, one a third of all rows and half of that one article repeated."""
    r = random.Random(4)
    rows, want = [], {}
    for i in range(120):
        layout = (news, plain, forum)[i % 3]
        title, body = prose(r, 4), [prose(r, 40) for _ in range(3)]
        if layout is plain and i % 2:
            title, body = "The same title", ["The same text on many pages of the host. " + " ".join(WORDS)] * 1
        rows.append((i, f"https://{layout.__name__}.example.org/", layout(r, i, title, body)))
        want[i] = "\n".join([title, *body])
    rows += rows[:9]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = templates.extract(pages).collect()
    assert len(found) == 129
    assert {x["page_id"]: x["text"] for x in found} == want


def test_pages_that_are_all_copies_keep_their_text(spark):
    r = random.Random(6)
    title, body = prose(r, 4), [prose(r, 40) for _ in range(3)]
    rows = [(i, "http://a.example.org/", news(r, i, title, body)) for i in range(12)]
    found = templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {x["text"] for x in found} == {"\n".join([title, *body])}


def test_template_text_of_optional_parts(spark):
    """A box on half of the pages shares its vector with its heading, which is template text there."""
    r = random.Random(8)
    rows = []
    for i in range(40):
        box = f'<section><h2>Background of the story</h2><p>{prose(r, 25)}</p></section>' if i % 2 else ""
        rows.append((i, "http://b.example.org/", f"<body><article><h1>{prose(r, 3)}</h1><p>{prose(r, 50)}</p>{box}</article></body>"))
    found = templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert not any("Background" in x["text"] for x in found)
    assert all(x["text"].count("\n") == 1 + x["page_id"] % 2 for x in found)


def test_odd_pages(spark):
    rows = [
        (1, "http://x.org/", None), (2, None, ""), (None, "no host", "<p>Only a paragraph &amp; no more"), (3, "http://x.org", "just text"),
        (4, "http://x.org/", "<article>a<b>b</b>c<br>d &lt;e&gt; &#233;&nbsp;f  \n g</article>"),
        (5, "http://x.org/", "<article><p>one<p>two<ul><li>three<li>four</ul><!-- no > --><script>var t='</p>';</script>five</article>"),
        (6, "http://x.org/", "<article><p>3 < 4 & 5 > 2</p><style>p{}</style><p title='a>b'>quoted</article>"),
        (7, "http://x.org/", "<article><p>open <!-- comment"), (7, "http://x.org/", "<article><p>open <!-- comment"),
        (8, "http://x.org/", "<article><p>" + "long " * 200_000 + "</p></article>"), (9, "http://x.org/", "<nav>menu</nav>"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = templates.extract(pages).collect()
    texts = {x["page_id"]: x["text"] for x in found}
    assert len(found) == len(rows)
    assert texts[1] == "" and texts[2] == "" and texts[None] == "Only a paragraph & no more" and texts[3] == "just text"
    assert texts[4] == "abc d <e> é f g"
    assert texts[5] == "one\ntwo\nthree\nfour\nfive"
    assert texts[6] == "3 < 4 & 5 > 2\nquoted"
    assert texts[7] == "open" and len(texts[8]) == 999_999 and texts[9] == ""
    assert templates.extract(pages.filter("page_id > 99")).collect() == []


@pytest.mark.parametrize("html", [
    "<a " * 100_000, '<a "' * 100_000, "<div>" * 50_000, "<!" * 100_000, "<div>" * 30_000 + "</p>" * 30_000,
    "<ul><li>" * 20_000 + "<li>" * 20_000, "<table><tr>" + "<td>x" * 50_000, "&" * 300_000, "<script>" * 50_000,
    "<p hidden" * 50_000, "<p class='" + "x " * 200_000,
])
def test_scanning_is_linear(html):
    start = time.time()
    page = templates.Page(html)
    templates.main_text(page, None, templates.Template([]))
    list(templates.page_tokens(html, 1))
    assert time.time() - start < 5


def test_equivalence_classes():
    """Text whose vector is its element's is template, copied text without an element of its vector is not."""
    def token(t, parent, is_run, low, pages=10):
        return {"token": t, "parent": parent, "is_run": is_run, "low": low, "high": 0, "pages": pages, "most": 1, "chars": 50, "linked": 0}

    found = templates.Template([
        token(0, 0, False, 1), token(1, 0, False, 1), token(2, 1, False, 7, 6), token(3, 2, True, 7, 6),
        token(4, 1, True, 9, 5), token(5, 1, True, 9, 5), token(6, 2, True, 1), token(8, 99, False, 3, 4),
    ])
    assert found.runs == {3, 6} and set(found.roles) == {0, 1, 2}
