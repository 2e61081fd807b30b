import hashlib
import math
import random
import re
import time

import numpy as np
import pytest
import xxhash

from ledgerline.llm import fingerprints, html_text

PAGES = {
    "": "",
    "<p>just one": "just one",
    "plain &lt;b&gt; text": "plain <b> text",
    "<nav>menu</nav>": "",
    '<article><h1>T</h1><p>a<br>b<script>var x="</p>"</script> c</p><aside>no</aside><ul><li>one<li>two</ul></article><article class="comment">bad</article>': "T\na b c\none\ntwo",
    "<body><header>head</header><article><p><b>Bold <i>text</b> on.<br><p>Next&nbsp;one &amp; more.</article><footer>f</footer>": "Bold text on.\nNext one & more.",
    '<div id="top-menu"><a>Home</a></div><div class="content"><h1>Title here</h1><p>Long paragraph of the real text goes here, with many words.<p>Short.<p>Another long paragraph with quite a number of words in it.</div>'
    '<div class="comments"><p>A reader comment that is very long and should not be taken into the text at all.</p></div><div class=cookie-notice>We use cookies</div>': "Title here\nLong paragraph of the real text goes here, with many words.\nShort.\nAnother long paragraph with quite a number of words in it.",
    '<article><p style="display: none">no</p><p hidden>no</p><p>yes</article>': "yes",
    "<article><header><h1>Own heading</h1></header><p>Text</article>": "Own heading\nText",
}


@pytest.mark.parametrize("html", PAGES)
def test_main_text(html):
    assert html_text.main_text(html) == PAGES[html]


BODY = "<p>The first paragraph of the article, long enough to be its text.<p>A second one."
CLEAR = "The first paragraph of the article, long enough to be its text.\nA second one."


@pytest.mark.parametrize("wrapper", ['div class="layout with-sidebar"', 'div id="page" class="no-sidebar"', 'div class="header-fixed"', 'section class="comment-page"', 'div class="sidebar-right social"'])
def test_wrappers_with_telling_names(wrapper):
    page = f"<body><{wrapper}><nav>menu</nav>{{}}<div class='sidebar'><a>One</a> <a>Two</a></div></{wrapper.split()[0]}></body>"
    assert html_text.main_text(page.format(f"<article>{BODY}</article>")) == CLEAR
    assert html_text.main_text(page.format(f"<main>{BODY}</main>")) == CLEAR
    assert html_text.main_text(page.format(f"<div>{BODY}</div>")) == CLEAR


def test_headings_with_telling_names():
    for title in ('<h1 class="header">Title</h1>', '<div class="article-header"><h1>Title</h1></div>', '<div class="masthead">Title</div>'):
        assert html_text.main_text(f"<article>{title}{BODY}</article>") == "Title\n" + CLEAR
    assert html_text.main_text(f'<div class="header">Site</div><article>{BODY}<div class="related"><article>Other</article></div></article><div class="comments"><p>{CLEAR * 3}</div>') == CLEAR


def test_text_around_and_between_articles():
    long, short = "A long part of the text. " * 40, "A shorter part of it. " * 18
    lines = lambda *parts: "\n".join(x.strip() for x in parts)
    assert html_text.main_text(f"<article><p>{long}</article><article><p>{short}</article>") == lines(long, short)
    assert html_text.main_text(f"<main><h1>Title</h1><p>Lead</p><article><p>{long}</article><p>End</main>") == lines("Title", "Lead", long, "End")
    assert html_text.main_text(f"<article><p>{short}<article><p>{long}</article><p>End</article>") == lines(short, long, "End")
    assert html_text.main_text(f"<div><h1>Title</h1><article><p>{long}</article><h2>Next</h2><article><p>{short}</article><article class='related'><p>x</article></div>") == lines("Title", long, "Next", short)


@pytest.mark.parametrize("wrapper", ['div class="content has-sidebar"', 'div class="main side-by-side"', 'div class="entry share-enabled"', "form"])
def test_wrappers_around_the_whole_page(wrapper):
    for inner in (BODY, f"<article>{BODY}</article>"):
        assert html_text.main_text(f"<body><nav>menu</nav><{wrapper}>{inner}</{wrapper.split()[0]}><footer>f</footer></body>") == CLEAR


@pytest.mark.parametrize("given", [lambda r: np.ones(len(r)), lambda r: np.roll(r, -2), lambda r: r.max() - r])
def test_ratios_decide(monkeypatch, given):
    page = f"<nav>menu</nav><div class='ad'>Buy this today, it is new.</div><article><h1>T</h1>{BODY}</article><div><a>One link</a> <a>and another</a></div><footer>f</footer>"
    assert html_text.main_text(page) == "T\n" + CLEAR
    smooth = html_text.smooth
    monkeypatch.setattr(html_text, "smooth", lambda ratios, zones, sigma: given(smooth(ratios, zones, sigma)))
    assert html_text.main_text(page) != "T\n" + CLEAR


LONG = "A reader says that all of this is wrong, and goes on about it. "


def test_comments_and_adverts_longer_than_the_article():
    comments = "".join(f'<div class="comment"><p>{LONG * 8}</p></div>' for _ in range(5))
    assert html_text.main_text(f'<article><h1>H</h1><p>Short.</p><section id="comments"><h2>Comments</h2>{comments}</section></article>') == "H\nShort."
    assert html_text.main_text(f'<div class="text"><h1>H</h1>{BODY}</div><section id="comments"><h2>Comments</h2>{comments}</section>') == "H\n" + CLEAR
    assert html_text.main_text(f'<article><h1>H</h1><p>Short.</p><div class="ad">{LONG * 6}</div><p>End.</p></article>') == "H\nShort.\nEnd."


def test_lines_do_not_live_on_their_neighbours():
    menu = "<div><ul><li><a>One</a><li><a>Two</a></ul></div>"
    page = f"<div><a>Home</a> | <a>Contact</a></div><div><h1>Title</h1></div><div>{BODY}<p>Short.</div>{menu}<div><p>Imprint</p></div>"
    assert html_text.main_text(page) == f"Title\n{CLEAR}\nShort."
    assert html_text.main_text(menu) == "One\nTwo"  # nothing else there


SENTENCES = "A long paragraph with many words that tell of something in full sentences, as articles do. " * 4
FOOT = "© 2024 Example Ltd. All rights reserved. Printed in some town, by somebody."
BY_HAND = {
    f"<div><a>Home</a> <a>News</a> <a>About us</a></div><div><h1>T</h1><p>{SENTENCES}</p><p>{SENTENCES}</p></div><div>{FOOT}</div>": ["T", SENTENCES, SENTENCES],
    f"<div><a>Home</a> <a>News</a></div><div><h1>T</h1><p>{SENTENCES}</p><p>{SENTENCES}</p></div><div><p>{FOOT}</p></div>": ["T", SENTENCES, SENTENCES],
    f"<body><div>Home News</div><h1>T</h1><p>{SENTENCES * 2}</p><p>{SENTENCES}</p><p>End.</p><div>{FOOT}</div></body>": ["T", SENTENCES * 2, SENTENCES, "End."],
    f"<div><h1>T</h1><ol><li>{SENTENCES}</li><li>Step two is short.</li></ol></div><div><ul><li><a>x</a></li><li><a>y</a></li></ul></div>": ["T", SENTENCES, "Step two is short."],
    f"<body><h1>T</h1><ol><li>{SENTENCES}</li><li>Second.</li></ol><p>End.</p></body>": ["T", SENTENCES, "Second.", "End."],
    f"<div><h2>T</h2><p>Take:</p><ul><li>{SENTENCES}</li></ul><p>Done.</p></div><div><ul><li>One</li></ul></div>": ["T", "Take:", SENTENCES, "Done."],
    f"<article><h1>Soup</h1><menu><li>Cut the roots.</li><li>Boil them.</li></menu><p>{SENTENCES}</p></article>": ["Soup", "Cut the roots.", "Boil them.", SENTENCES],
    f"<menu><li><a>One</a></li><li><a>Two</a></li></menu><div><p>{SENTENCES}</p></div>": [SENTENCES],
    f"<article><p>{SENTENCES}</p><menu><li><a>Share</a></li></menu></article>": [SENTENCES],
}


@pytest.mark.parametrize("html", BY_HAND)
def test_pages_without_telling_names(html):
    assert html_text.main_text(html) == "\n".join(x.strip() for x in BY_HAND[html])


def test_deep_pages_take_linear_time():
    def seconds(page):
        began = time.process_time()
        assert html_text.main_text(page)
        return time.process_time() - began

    for make in (lambda n: "<div>" * n + "text", lambda n: "<div>" * n + "<li>x</li>" * n + "</section>" * n, lambda n: "<div class=ad><span>" * n + "text"):
        small, large = min(seconds(make(2500)) for _ in range(3)), min(seconds(make(20_000)) for _ in range(2))
        assert large < 8 * small * 4


def plainly(page):
    """The main text of a page of <p>, <h2>, <a>, <nav>, <div>, <article> and <div class="ad">, all closed, by lists and loops."""
    lines, ads, stack, tags, dark, number = [], [], [], 0, False, 0
    text = None
    for token in re.findall("<[^>]+>|[^<]+", page):
        name = re.match("</?([a-z0-9]+)", token)
        if not name:
            if any(e["tag"] == "nav" for e in stack):
                dark = True
            else:
                blocks = [e for e in stack if e["tag"] != "a"]
                articles = [k for k, e in enumerate(stack) if e["tag"] == "article"]
                around = blocks[-2]["n"] if len(blocks) > 1 else 0
                apart = len(blocks) == 1 and blocks[0]["tag"] not in ("p", "h2")  # a block of the page's own
                text = text or {"parts": [], "parent": -blocks[0]["n"] if apart else around, "around": around, "heading": blocks[-1]["tag"] == "h2" if blocks else False, "group": (stack[articles[0] - 1]["n"] if articles[0] else 0) if articles else -1}
                text["parts"].append((token, stack[-1]["ad"] if stack else 0, any(e["tag"] == "a" for e in stack)))
            continue
        opening = token[1] != "/"
        tags += not opening
        if name[1] != "a":
            if text or dark:
                lines.append((text, tags))
                tags, dark = 0, False
            text = None
        tags += opening
        if opening:
            number += 1
            ad = stack[-1]["ad"] if stack else 0
            if "ad" in token.split('"'):
                ads.append({"free": 0, "in_article": any(e["tag"] == "article" for e in stack)})
                ad = len(ads)
            stack.append({"tag": name[1], "n": number, "ad": ad})
        else:
            stack.pop()
    if text or dark:
        lines.append((text, tags))
    free = [0] * (len(ads) + 1)
    for line, _ in lines:
        for part, ad, link in line["parts"] if line else ():
            free[ad] += 0 if link else len(part.strip())
    articles, zone = any(line and line["group"] >= 0 for line, _ in lines), list(range(len(ads) + 1))
    for k in range(len(ads), 0, -1):  # no ad holds another
        if free[k] and 2 * free[k] >= sum(free) and not ads[k - 1]["in_article"] and not articles:
            zone[k] = 0
    ratios = [(zone[line["parts"][0][1]], sum(len(t.strip()) * (0.1 if link else 1) for t, _, link in line["parts"]) * (0.001 if zone[line["parts"][0][1]] else 1) / tags) if line else (-1, 0.0) for line, tags in lines]
    smoothed = []
    for k, (z, _) in enumerate(ratios):
        near = [(math.exp(-((j - k) ** 2) / 2), ratios[j][1]) for j in range(max(0, k - 3), min(len(ratios), k + 4)) if ratios[j][0] in (z, -1)]
        smoothed.append(sum(w * r for w, r in near) / sum(w for w, _ in near))
    mean = sum(smoothed) / max(1, len(smoothed))
    cut = math.sqrt(sum((x - mean) ** 2 for x in smoothed) / max(1, len(smoothed)))
    cut *= 1 - 1e-9
    linked = [not line or not any(t.strip() and not link for t, _, link in line["parts"]) for line, _ in lines]
    strong = {lines[k][0]["parent"] for k, (z, r) in enumerate(ratios) if z >= 0 and smoothed[k] >= cut and r >= cut and not linked[k]}
    upper = [k for k, (z, r) in enumerate(ratios) if z >= 0 and smoothed[k] >= cut and (r >= cut or (r >= cut / 4 and (not strong or lines[k][0]["parent"] in strong)) or z or lines[k][0]["heading"])]
    seeds = [k for k in upper if any(t.strip() and not link for t, _, link in lines[k][0]["parts"])] or upper
    zones, groups = {0} | {ratios[k][0] for k in seeds}, {lines[k][0]["group"] for k in seeds} - {-1}
    left = [k for k, (z, _) in enumerate(ratios) if z in zones]
    at = [n for n, k in enumerate(left) if k in seeds or lines[k][0]["group"] in groups]
    if not at:
        return ""
    parents = {lines[k][0]["parent"] for k in seeds if lines[k][0]["group"] < 0} | groups - {0}
    first, last = at[0], at[-1]
    heads = lambda n: lines[left[n]][0]["heading"] and lines[left[n]][0]["parent"] == lines[left[n + 1]][0]["around"]
    while first and (lines[left[first - 1]][0]["parent"] in parents or heads(first - 1)):
        first -= 1
    while last + 1 < len(left) and lines[left[last + 1]][0]["parent"] in parents:
        last += 1
    return "\n".join(" ".join("".join(t for t, _, _ in lines[k][0]["parts"]).split()) for k in left[first : last + 1])


def test_pages_against_plain_code():
    rnd = random.Random(8)
    words = lambda n: " ".join(rnd.choice(["alpha", "be", "gammas", "d"]) for _ in range(n))

    def line():
        n = rnd.choice([1, 3, 8, 30, 90])
        return rnd.choice([f"<p>{words(n)}</p>"] * 4 + [f"<h2>{words(2)}</h2>", f"<p><a>{words(3)}</a> {words(1)} <a>{words(2)}</a></p>", f'<div class="ad">{words(n)}</div>', f"<nav><a>{words(2)}</a></nav>"])

    def section():
        inner = "".join(line() for _ in range(rnd.randint(0, 5)))
        return rnd.choice([inner, f"<div>{inner}</div>", f"<article>{inner}</article>", f"<div>{inner}<article>{line()}{line()}</article>{line()}</div>"])

    pages = ["".join(section() for _ in range(rnd.randint(0, 5))) for _ in range(1500)]
    found = [html_text.main_text(p) for p in pages]
    assert found == [plainly(p) for p in pages]
    assert sum("\n" in t for t in found) > 800 and len(set(found)) > 1000


def test_pages(spark, sf_dir):
    rows = [(1, "u", None, "x"), (2, None, "<p>t</p>", "x"), (2, None, "<p>t</p>", "x"), (3, "v", "<p>" + "long text " * 50_000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = html_text.extract(pages).collect()
    assert [(r.page_id, r.url, r.n_chars) for r in found] == [(1, "u", 0), (2, None, 1), (2, None, 1), (3, "v", 499_999)]
    assert html_text.extract(pages.where("false")).count() == 0
    real = html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    assert real.where("n_chars = 0 or text like '%<%'").count() == 0


def test_sketches_do_not_depend_on_company():
    texts = ["", "a", "aa", "abab" * 9, "the quick brown fox " * 30, "漢字かな" * 20, "x" * 5000, "the quick brown fox " * 30]
    together = fingerprints.sketches(texts)
    assert together == [fingerprints.sketches([t])[0] for t in texts]
    assert together[4] == together[7] and len(set(together)) == len(texts) - 1


def test_shared_parts_share_names():
    text = " ".join(str(k * k) for k in range(900))
    whole, shifted, other = fingerprints.sketches([text, "zq " + text, " ".join(str(k * k + 7) for k in range(3000, 3900))])
    assert fingerprints.likeness(whole, shifted) > 0.85
    assert fingerprints.likeness(whole, other) < 0.3
    assert fingerprints.likeness(*fingerprints.sketches(["", ""])) == 1


@pytest.mark.parametrize("hot", [[], [(77, f"of one id {k}") for k in range(400)] + [(None, f"of none {k}") for k in range(400)]])
@pytest.mark.parametrize("parts", [1, 5])
def test_next_documents(spark, parts, hot):
    rows = [(k * 7 % 301, f"text number {k} " * (k % 13)) for k in range(300)] + [(5, "twice"), (5, "twice"), (None, "no id"), (7_000, None)] + hot
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, range string").repartition(4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = fingerprints.compare_with_next(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    order = sorted(((i if i is not None else -1, t or "") for i, t in rows), key=lambda x: (x[0], xxhash.xxh64_intdigest(x[1].encode(), 42) + 2**63 & 2**64 - 1))
    if hot:
        view = fingerprints.common.docs_view(docs).select("doc_id", fingerprints.F.coalesce("text", fingerprints.F.lit("")).alias("text"))
        ranges = [r["count"] for r in fingerprints._ranged(view, 40).groupBy("range").count().collect()]
        assert max(ranges) < len(rows) / 8 and sum(ranges) == len(rows)
    expected = []
    for k, (i, t) in enumerate(order):
        n, cut = order[(k + 1) % len(order)][1], len(t) // 4
        edited = t[: len(t) - cut] + n[:cut]
        a, b, c = fingerprints.sketches([t, edited, n])
        expected.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), a, b, fingerprints.likeness(a, b), fingerprints.likeness(a, c)))
    assert sorted((r.doc_id if r.doc_id is not None else -1, *r[1:]) for r in found) == sorted(expected)


def plain_fingerprint(text, levels, bins):
    """By loops over Python numbers."""
    top = 2**64 - 1

    def mix(x):
        for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            x = (x ^ (x >> 33)) * factor & top
        return x ^ (x >> 33)

    def toss(labels):
        out = []
        for k, x in enumerate(labels):
            other = labels[k - 1] if k else x ^ top
            place = next(b for b in range(64) if (x ^ other) >> b & 1)
            out.append(2 * place + (x >> place & 1))
        return out

    golden, least = 0x9E3779B97F4A7C15, [0xFFFF] * bins
    symbols = [mix(ord(c) + 1) for c in text]
    for level in range(1, max(levels) + 1):
        if not symbols:
            break
        runs = []
        for x in symbols:
            if runs and runs[-1][0] == x:
                runs[-1][1] += 1
            else:
                runs.append([x, 1])
        symbols = [mix((x + n * golden) & top) if n > 1 else x for x, n in runs]
        labels = symbols
        for _ in range(3):
            labels = toss(labels)
        phrases = []
        for k, x in enumerate(symbols):
            inner = 1 < k < len(symbols) - 1
            if not phrases or inner and labels[k] < labels[k - 1] and labels[k] <= labels[k + 1]:
                phrases.append([])
            phrases[-1].append(x)
        symbols = [mix(sum(x * pow(golden, k + 1, 2**64) for k, x in enumerate(p)) & top) for p in phrases]
        if level in levels:
            for x in symbols:
                x = mix(x ^ level)
                at = (x >> 32) % bins
                least[at] = min(least[at], x & 0xFFFF, 0xFFFE)
    return "".join(f"{x:04x}" for x in least)


def test_sketches_against_loops():
    rnd = random.Random(1)
    texts = ["", "a", "ab", "aa", "aab", "abc", "🙂" * 9] + ["".join(rnd.choice("abc é漢\n" + "a" * rnd.choice([0, 9])) for _ in range(rnd.randint(1, 300))) for _ in range(150)]
    assert fingerprints.sketches(texts) == [plain_fingerprint(t, fingerprints.LEVELS, fingerprints.BINS) for t in texts]
    assert fingerprints.sketches(texts, (1, 3), 8) == [plain_fingerprint(t, (1, 3), 8) for t in texts]


def test_few_documents(spark):
    docs = spark.createDataFrame([(1, "alone with no next one")], "doc_id long, text string")
    assert fingerprints.compare_with_next(docs).first().near_next == 1
    assert fingerprints.compare_with_next(docs.where("false")).count() == 0
    named = spark.createDataFrame([("b", "bb"), ("a", "aa")], "doc_id string, text string")
    assert fingerprints.compare_with_next(named).count() == 2
