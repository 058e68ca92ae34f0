"""Line dedup, decontamination, extraction and quality rules against brute force."""

from __future__ import annotations

import random
import math
import re
import time
from collections import Counter

import numpy as np
import pytest
import xxhash

from lakeloom.llm import ORACLES, QUERIES, decontaminate, html_extract, line_dedup, load_all, quality_rules
from tests.compare import connect, differences, spark_result, type_differences
from tests.conftest import plan_text
from tests.llm.conftest import documents

load_all()
SPACES = " \t\n\x0b\x0c\r"


# Line dedup


def test_lines_as_sql(spark, folder):
    df = QUERIES["op6_line_dedup"](spark, folder)
    with connect(folder) as con:
        assert type_differences(df, con, ORACLES["op6_line_dedup"]) == []
        assert differences(spark_result(df), con, ORACLES["op6_line_dedup"]) == []


def test_boilerplate_goes_from_its_host_only(spark):
    rows = [(i, f"Menu\nOwn line {i}\n  Menu \nCommon", "x") for i in range(40)] + [(100 + i, f"Menu\nOther {i}", "y") for i in range(4)]
    rows += [(200 + i, "Common\nMenu" if i < 4 else f"Text {i}", "z") for i in range(50)]
    found = {r["doc_id"]: r for r in line_dedup.drop_boilerplate(documents(spark, rows), counters=("before", "dropped")).collect()}
    assert found[3]["text"] == "Own line 3" and (found[3]["before"], found[3]["dropped"]) == (4, 3)
    # Four pages are too few to tell, and four of fifty are below the ratio.
    assert found[100]["text"] == "Menu\nOther 0" and found[200]["text"] == "Common\nMenu"


def test_shared_lines_and_passages_go_and_single_ones_stay(spark):
    passage = " ".join(f"word{i}" for i in range(60))
    rows = [(i, f"Own line {i}\n" + ("Licensed to all\n" if i < 8 else "") + (passage if i % 60 == 0 else f"End {i}"), "x") for i in range(400)]
    rows += [(1000 + i, "A page\nand its copy", "x") for i in range(2)]
    found = {r["doc_id"]: r["text"] for r in line_dedup.drop_boilerplate(documents(spark, rows)).collect()}
    for key, text, _ in rows:
        assert found[key].split("\n") == [line for line in text.split("\n") if line not in ("Licensed to all", passage)]


def test_lines_of_messy_rows(spark, messy, nothing):
    cleaned = line_dedup.drop_boilerplate(messy, min_pages=2)
    assert cleaned.columns == messy.columns and cleaned.count() == messy.count()
    found = {(r["doc_id"], r["text"]) for r in cleaned.collect()}
    assert (3, None) in found and (None, None) in found and (1, "") in found
    assert any(i == 8 and t.endswith("again\nagain") for i, t in found)
    assert line_dedup.drop_boilerplate(nothing).count() == 0
    everything_dropped = [(i, "same", "h") for i in range(9)]
    assert {r["text"] for r in line_dedup.drop_boilerplate(documents(spark, everything_dropped)).collect()} == {""}


# Decontamination


def distance_in(item, text):
    """The least edit distance of an item to a part of a text, by the textbook."""
    before = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        now = [i]
        for j, d in enumerate(text, 1):
            now.append(min(before[j] + 1, now[j - 1] + 1, before[j - 1] + (c != d)))
        before = now
    return min(before)


def test_distances_as_the_textbook():
    rng = random.Random(1)
    for _ in range(400):
        item = "".join(rng.choice("abc") for _ in range(rng.randint(1, 12)))
        text = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 25)))
        most = rng.randint(0, len(item) - 1)
        best = distance_in(item, text)
        found = decontaminate.nearest_end(decontaminate.masks(item), len(item), text, most)
        assert (found[0] if found else None) == (best if best <= most else None)


def spoiled(rng, text, edits):
    for _ in range(edits):
        at = rng.randrange(len(text))
        text = text[:at] + rng.choice(["", "q", text[at] + "z"]) + text[at + 1 :]
    return text


def test_no_passage_within_the_budget_is_missed(spark):
    rng = random.Random(2)
    words = [f"{a}{b}" for a in ("ba", "de", "fi", "go", "hu") for b in ("n", "r", "st", "")]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(20)) for i in range(12)]
    rows = []
    for i in range(90):
        item = items[i % len(items)][1]
        inside = spoiled(rng, item, rng.randint(0, 14)) if i % 3 else text(20)
        rows.append((i, f"{text(8)}  {inside.upper()}\n{text(8)}"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.matches(documents(spark, rows), bench).collect()
    expected = set()
    for key, body in rows:
        for item_id, item in items:
            if (d := distance_in(item, decontaminate.normalised(body))) <= int(0.1 * len(item)):
                expected.add((key, item_id, d))
    assert {(r["doc_id"], r["item_id"], r["distance"]) for r in found} == expected and len(expected) > 20
    for r in found:
        part = decontaminate.normalised(rows[r["doc_id"]][1])[r["start"] : r["end"]]
        item = items[r["item_id"]][1]
        assert distance_in(item, part) == r["distance"] and abs(len(part) - len(item)) <= r["distance"]
    small_blocks = decontaminate.matches(documents(spark, rows), bench, block_chars=150)
    assert {tuple(r) for r in small_blocks.collect()} == {tuple(r) for r in found}
    kept = decontaminate.drop_contaminated(documents(spark, rows), bench, block_chars=150)
    assert {r["doc_id"] for r in kept.collect()} == {k for k, _ in rows} - {k for k, _, _ in expected}


def test_benchmark_of_messy_rows(spark, messy, nothing):
    line = "Some plain words that make a text of more than ten words"
    bench = spark.createDataFrame([(1, line), (1, line), (2, None), (3, ""), (4, "short")], "item_id long, text string")
    found = decontaminate.matches(messy, bench).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in found} == {1: 4, 2: 2}
    kept = decontaminate.drop_contaminated(messy, bench)
    assert kept.columns == messy.columns and kept.count() == messy.count() - 3
    none = bench.where("item_id > 9")
    assert decontaminate.matches(messy, none).count() == 0 and decontaminate.drop_contaminated(messy, none).count() == messy.count()
    assert decontaminate.matches(nothing, bench).count() == 0


def test_texts_are_searched_without_a_shuffle(spark, folder):
    docs, bench = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    assert "Exchange" not in plan_text(decontaminate.matches(docs, bench))


# Extraction

PAGE = """<html><head><title>Site</title><style>p{}</style></head><body class="has-sidebar"><header><a href=/>Home</a> My site</header>
<div id="cookie-notice">We use cookies and more cookies on this site, as you know very well, so accept them all.</div>
<div class="sidebar"><p>Popular things here and there, a list of many things that are popular with many readers.</p></div>
<div class="post-content"><h2>Title</h2><p>One long paragraph &amp; text that is <b>lon</b>ger than the rest, and has <a href=x>a link</a>.
<p>Short.</p><script>var a = "</p> no";</script><div class="ad">Buy this now and be happy for ever, it is cheap and good and new.</div>
<p>Another long paragraph with&nbsp;many   words in it &mdash; it goes on for some time, 1 &lt; 2.</p><aside>Read also</aside><p>End.</p></div>
<div id="comments"><p>I like this very much indeed, thank you for it, it was a great read for me and mine.</p></div>
<form><input><p>Subscribe now</p></form><footer>&copy; x</footer></body></html>"""
TEXT = (
    "Title One long paragraph & text that is longer than the rest, and has a link. Short. "
    "Another long paragraph with many words in it — it goes on for some time, 1 < 2. End."
)


def test_article_without_its_surroundings():
    marked = PAGE.replace('<div class="post-content">', "<article>").replace('End.</p></div>', "End.</p></article>")
    assert html_extract.main_text(marked) == TEXT


def test_text_between_surge_and_dive():
    assert html_extract.main_text(PAGE) == TEXT
    # Without a marked article what follows the last dive needs a surge of its own.
    assert html_extract.main_text(PAGE.replace(' class="post-content"', "")) == TEXT.removesuffix(" End.")
    weights = [0, 5, 0, 0, 0, 30, 60, 2, 0, 40, 0, 0, 0, 9, 0, 0, 0, 70, 0]
    assert [i for i, keep in enumerate(html_extract.between_surge_and_dive(weights)) if keep] == list(range(5, 18))


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""), ("no markup at all", "no markup at all"), ("<nav><a>x</a></nav>", ""), ("<article><p>a<b>b</b></p>c</article>", "ab c"),
        ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"), ("<article><p>unclosed", "unclosed"), ("<!-- <p>no</p> --><p>yes</p>", "yes"),
        ("<article><p>a</p><table><tr><td>b</td><td>c</td></tr></table></article><p>out</p>", "a b c"),
        ("<article><p class=\"ad\">buy<p>x</article>", "x"), ("<main><article><p>x</p><article class='comment'>hate</article></article></main>", "x"),
    ],
)
def test_small_pages(page, text):
    assert html_extract.main_text(page) == text


def test_marks_are_evidence_only():
    story = " ".join(f"<p>Sentence {i} of the story itself, which stands in a plain element.</p>" for i in range(20))
    teaser = "<article><h3>Read next</h3><p>A short teaser of another story.</p></article>"
    nav = "<div class='sidebar'>Menu</div>"
    expected = " ".join(f"Sentence {i} of the story itself, which stands in a plain element." for i in range(20))
    assert html_extract.main_text(f"<body>{nav}<div>{story}</div>{nav}{teaser}</body>") == expected
    assert html_extract.main_text(f"<body>{teaser}{nav}<article>{story}</article></body>").endswith(expected)


@pytest.mark.parametrize(
    "inside, text",
    [
        ("<svg-icon name='x'></svg-icon><p>b</p>", "a b c"), ("<title-bar></title-bar>b", "a b c"), ("<svg class='i'/>b", "a b c"),
        ("<svg><title/><path d=''/><text>no</text></svg>b", "a b c"), ("<svg><title>no</title>no<p>b</p>", "a"), ("<math/><object>no</object>b", "a b c"),
        ("<template><div>no</div>no</template>b", "a b c"), ("<script-x>b</script-x><script>no</script>", "a b c"), ("<noscript>no", "a"),
    ],
)
def test_elements_that_are_not_shown(inside, text):
    assert html_extract.main_text(f"<article><p>a</p>{inside}<p>c</p></article>") == text
    assert html_extract.main_text(f"<article><div>{inside}</div></article><article>end</article>").endswith("end")


def test_given_pages(spark, folder):
    import html

    for row in QUERIES["op5_html_text"](spark, folder).join(spark.read.parquet(f"{folder}/pages.parquet"), "page_id").collect():
        body = re.sub(r"</?b>", "", re.search(r"<article>(.*?)</article>", row["html"], re.S)[1])
        assert row["text"] == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", body)).split())
        assert row["n_chars"] == len(row["text"])


LONG = "A long article sentence that holds enough words to surge over the threshold of a window. " * 6
ASIDE = "Buy this now or read what others have to say about it, with plenty of words in one block here. " * 2


@pytest.mark.parametrize(
    "name",
    ["sidebar-content", "footer-wrapper", "ad-container", "cookie-banner-text", "newsletter-container", "main-menu", "nav-main",
     "related-post", "share-container", "comments-area", "share-this"],
)
def test_the_head_word_of_a_class_drops_its_element(name):
    part = f'<div class="{name}"><p>{ASIDE}</p></div>'
    assert html_extract.main_text(f"<div><p>{LONG}</p></div>{part}") == LONG.strip()
    assert html_extract.main_text(f"{part}<div><p>{LONG}</p></div>") == LONG.strip()
    assert html_extract.main_text(f"<article><p>{LONG}</p>{part}</article>") == LONG.strip()


@pytest.mark.parametrize(
    "page",
    ['<div class="social-news"><p>{}</p></div>', '<section class="search-results-study"><p>{}</p></section>',
     '<p class="share-study">{}</p>', '<div class="container no-sidebar"><p>{}</p></div>',
     '<div class="social-news"><div class="search-study"><p>{}</p></div></div>', '<div class="post-header"><p>{}</p></div>'],
)
def test_a_word_elsewhere_in_a_class_drops_no_article(page):
    aside = f'<div class="share-this"><p>{ASIDE}</p></div>'
    assert html_extract.main_text(page.format(LONG)) == LONG.strip()
    assert html_extract.main_text(aside + page.format(LONG) + aside) == LONG.strip()


def test_pages_without_marks_give_the_same_text(folder):
    """The given pages with their articles renamed reach the distribution alone."""
    import pyarrow.parquet as pq

    for page in pq.read_table(f"{folder}/pages.parquet", columns=["html"])["html"].to_pylist():
        renamed = re.sub(r"</?(?:article|main)\b[^>]*>", lambda tag: "</div>" if tag[0][1] == "/" else "<div>", page)
        assert "<article" not in renamed
        assert html_extract.main_text(renamed) == html_extract.main_text(page)



def test_messy_pages(spark):
    pages = spark.createDataFrame(
        [(1, None, None), (None, "u", ""), (2, "u", PAGE), (2, "u", PAGE), (3, "u", "<p>" + "word " * 300_000)],
        "page_id long, url string, html string",
    ).selectExpr("*", "1 as text_", "2 as weight")
    found = html_extract.extract(pages, into="main").collect()
    assert len(found) == 5 and {r["main"] for r in found if r["html"] is None or r["html"] == ""} == {""}
    assert max(len(r["main"]) for r in found) == 300_000 * 5 - 1
    assert html_extract.extract(pages.where("page_id > 9")).count() == 0


def test_short_items_are_found_as_they_are(spark):
    items = spark.createDataFrame([(1, "Two  Words"), (2, "x"), (3, ""), (4, " \n"), (5, "q: 7+5?")], "item_id int, text string")
    docs = documents(spark, [(1, "here are two\nwords."), (2, "two wordsmith"), (3, "ax x"), (4, "Q: 7+5? 12"), (5, None), (6, "two wirds"), (7, "axe")])
    found = {(r.doc_id, r.item_id, r.distance) for r in decontaminate.matches(docs, items).collect()}
    assert found == {(1, 1, 0), (3, 2, 0), (4, 5, 0)}
    assert {r.doc_id for r in decontaminate.drop_contaminated(docs, items).collect()} == {2, 5, 6, 7}


# Quality rules


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [line for line in (text or "").split("\n") if line.strip(SPACES)]
    n = len(words)
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": n < 10 or 100 * len(covered) > 20 * n,
    }


def grams(text, buckets):
    """Buckets of words and of neighbouring words, hashed as Spark's xxhash64 does."""
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    words = [xxhash.xxh64_intdigest(w.encode(), 42) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    pairs = [
        xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42))
        for a, b in zip(words, words[1:], strict=False)
    ]
    return np.array([signed(h) & (buckets - 1) for h in words + pairs], np.int64)


def test_rules_as_counted_by_hand(spark, folder):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    trusted = {r["doc_id"] for r in spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1").collect()}
    wished = quality_rules.wished_buckets(sum(len(grams(t, 2)) for t in docs.values()))
    buckets = 1 << math.ceil(math.log2(wished))
    coarse = math.log2(buckets) - math.log2(wished)
    assert 0 < coarse < 1
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for key, text in docs.items():
        np.add.at(raw, grams(text, buckets), 1)
        if key in trusted:
            np.add.at(target, grams(text, buckets), 1)
    ratio_of = lambda r, t: np.log((t + quality_rules.PRIOR) / (r * target.sum() / raw.sum() + quality_rules.PRIOR))
    halves = [np.tile(x[: buckets // 2] + x[buckets // 2 :], 2) for x in (raw, target)]
    ratios = ((1 - coarse) * ratio_of(raw, target) + coarse * ratio_of(*halves)).round(6)
    rows = QUERIES["op10_quality_rules"](spark, folder).collect()
    assert len(rows) == len(docs)
    for row in rows:
        expected = base(docs[row["doc_id"]])
        assert {k: row[k] for k in expected} == expected
        found = grams(docs[row["doc_id"]], buckets)
        ratio = ratios[found].mean() if len(found) else 0.0
        assert row["ratio"] == pytest.approx(ratio, abs=1e-6)
        if abs(ratio - quality_rules.MIN_RATIO) > 1e-5:
            assert row["kept"] == (not expected["base_failed"] and ratio >= quality_rules.MIN_RATIO)


def test_rules_leave_good_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = QUERIES["op10_quality_rules"](spark, folder).join(labels, "doc_id")
    kept = {(r["quality"], r["kept"]): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    assert kept.get((1, False), 0) <= 0.03 * kept[1, True]
    assert kept[0, False] >= 0.9 * (kept[0, False] + kept.get((0, True), 0))


def test_rules_of_repeated_windows(spark, messy, nothing):
    texts = ["a b c d e a b c d e", "x " * 30, "a b c d e f g h i j k", "q a b c d e f a b c d e f z", None, "", "one two", "a  b\tc\x0bd\re\nf"]
    rows = documents(spark, list(enumerate(texts)))
    model = quality_rules.fit(rows, rows.where("doc_id = 2"))
    for row in quality_rules.judge(rows, model, into="verdict").collect():
        expected = base(row["text"])
        assert {k: row["verdict"][k] for k in expected} == expected
    judged = quality_rules.judge(messy, model, into="verdict")
    assert judged.columns == [*messy.columns, "verdict"] and judged.count() == messy.count()
    assert quality_rules.keep_good(messy, model).columns == messy.columns
    empty = quality_rules.fit(messy, messy.where("false"))
    assert {r["verdict"]["ratio"] for r in quality_rules.judge(messy, empty, into="verdict").collect()} == {0.0}
    assert quality_rules.judge(nothing, quality_rules.fit(nothing, nothing)).count() == 0


def test_rules_use_no_python(spark, messy):
    text = plan_text(quality_rules.judge(messy, quality_rules.fit(messy, messy)))
    assert not [x for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop") if x in text]


def test_rules_reject_bad_documents_of_a_larger_table(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = QUERIES["op10_quality_rules"](spark, folder).where("not base_failed").join(labels, "doc_id")
    kept = {(r["quality"], r["kept"]): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    assert kept.get((0, True), 0) <= 0.04 * (kept[0, False] + kept.get((0, True), 0))
    assert kept.get((1, False), 0) <= 0.01 * kept[1, True]


def test_buckets_grow_without_a_jump(spark, folder):
    wished = [quality_rules.wished_buckets(n) for n in (0, 10**6, 10**9, 10**12)]
    assert wished == pytest.approx([2, 51_200, 512_000, 5_120_000])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    trusted = docs.where("doc_id % 3 = 0")
    ratios = [
        [r["quality"]["ratio"] for r in quality_rules.judge(docs, quality_rules.fit(docs, trusted, buckets=b)).orderBy("doc_id").collect()]
        for b in (1 << 12, (1 << 12) + 1, 1 << 13)
    ]
    assert ratios[0] == pytest.approx(ratios[1], abs=2e-4) and ratios[0] != pytest.approx(ratios[2], abs=2e-4)


def test_rules_with_shuffled_ratios(spark, folder, monkeypatch):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs = docs.unionByName(docs.limit(20))
    model = quality_rules.fit(docs, docs.where("doc_id % 3 = 0"))
    found = lambda: quality_rules.judge(docs, model).orderBy("doc_id").select("doc_id", "quality").collect()
    broadcast = found()
    monkeypatch.setattr(quality_rules, "BROADCAST_BUCKETS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert found() == broadcast and len(broadcast) == docs.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len({r["quality"]["ratio"] for r in broadcast}) > 100


@pytest.mark.parametrize("condition", ["kept", "not kept", "not base_failed", "ratio > 0", "n_words > 20", "word_chars > 9", "n_symbols = 0", "n_dup_lines > 0", "n_repeat_words > 5"])
def test_rules_can_be_filtered(spark, folder, condition):
    rows = QUERIES["op10_quality_rules"](spark, folder)
    started = time.time()
    assert 0 < rows.where(condition).count() <= rows.count()
    assert time.time() - started < 20
