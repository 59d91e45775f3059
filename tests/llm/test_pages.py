"""Neighbours of pages, and what the markup and the neighbours decide."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from aeromart.llm import pages

SCHEMA = "page_id long, url string, html string"
SLUGS = "about-us budget-report city-news river-walk school-meals town-hall weather winter-fair".split()


def texts(spark, rows, **more):
    return {r["page_id"]: r["text"] for r in pages.extract_text(spark.createDataFrame(rows, SCHEMA), **more).collect()}


def test_word_slugs_meet_at_every_size(spark):
    rng = random.Random(3)
    body = "<div>top bar</div><div>welcome to the site</div><div>{}</div><div>all rights</div>"
    rows = [(i, f"https://h.org/{s}", body.format(" ".join(rng.choices("abcdefgh", k=60)))) for i, s in enumerate(SLUGS)]
    rows.append((99, "https://lone.org/x", body.format("alone")))
    rng.shuffle(rows)
    found = texts(spark, rows)
    assert all("top bar" not in found[i] and "all rights" not in found[i] and found[i] for i in range(len(SLUGS)))
    assert found[99].startswith("top bar")
    for ranges in (3, 50):  # ranges as short as a page change nothing
        assert texts(spark, rows, ranges=ranges) == found


def test_both_neighbours_decide_at_the_ends_of_articles(spark):
    rng = random.Random(4)
    own = [" ".join(rng.choices("abcdefgh", k=60)) for _ in range(5)]
    licence = "This work is licensed under the GNU General Public License, version 3."
    body = "<p>site</p><article><div>By the desk of the Herald</div><p>{}</p><p>{}</p><div><p>Share this story</p><p>About the author</p></div></article>"
    rows = [(i, f"https://h.org/{s}", body.format(licence if i else "a first line", own[i])) for i, s in enumerate(SLUGS[:5])]
    found = texts(spark, rows)
    # A line that the near pages happen to share stays unless it is part of the frame of all three.
    assert [found[k] for k in (1, 2, 3)] == [f"{licence}\n\n{own[k]}" for k in (1, 2, 3)]
    # The first and the last page of a host have one neighbour only.
    assert "Herald" in found[0] and "Share" in found[4]


def test_the_same_words_in_other_elements_and_copies_stay(spark):
    one, two = "<article><p>{0}</p><p>text {1}</p></article>", "<article><h2>{0}</h2><p>text {1}</p></article>"
    rows = [(i, f"https://h.org/{s}", (two if i == 2 else one).format("The same words", s)) for i, s in enumerate(SLUGS[:3])]
    assert all(t.startswith("The same words") for t in texts(spark, rows).values())
    long = " ".join(f"w{i}" for i in range(80))
    copies = [(i, f"https://h.org/{s}", f"<article><p>{long}</p><p>{i % 2}</p></article>") for i, s in enumerate(SLUGS)]
    copies += [(9, f"https://h.org/{SLUGS[0]}", copies[0][2])]
    assert all(t.startswith(long) for t in texts(spark, copies).values())


def test_against_a_plain_run_over_all_pages(spark):
    """Pairing and alignment replayed page by page, with a longest common subsequence by its table."""
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html").collect()]
    rows += [(10_000 + i, u.replace("://", "://loose."), h.replace("<article", "<div").replace("</article", "</div")) for i, u, h in rows[:120]]

    def key(row):
        host, path = row[1].split("://")[1].split("/", 1)
        stem = re.sub(r"(/|\.[A-Za-z]{2,5})$", "", "/" + path.split("?")[0].split("#")[0])
        return host.lower(), stem, row[1], str(row[0])

    def lcs(a, b):
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a) - 1, -1, -1):
            for j in range(len(b) - 1, -1, -1):
                table[i][j] = table[i + 1][j + 1] + 1 if a[i] == b[j] else max(table[i + 1][j], table[i][j + 1])
        return table[0][0]

    rows.sort(key=key)
    parsed = [pages.lines_of(r[2]) for r in rows]
    found = texts(spark, rows)
    for k, row in enumerate(rows):
        near = [j for j in (k - 1, k + 1) if 0 <= j < len(rows) and key(rows[j])[0] == key(row)[0]]
        near.sort(key=lambda j: -len(os.path.commonprefix([key(rows[j])[1], key(row)[1]])))
        assert found[row[0]] == pages.main_text(parsed[k], *(parsed[j] for j in near))
        for j in near:
            assert len(pages.common_lines(parsed[k].texts, parsed[j].texts)) == lcs(parsed[k].texts, parsed[j].texts)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_the_article_is_the_whole_document(spark, sf):
    """Every page of the tables holds one of the documents; no line of it may be lost."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("text").collect()
    known = {re.sub(r"\s+", "", r["text"] or "") for r in docs}
    found = pages.extract_text(spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")).collect()
    # The page's own heading stands before the text.
    whole = [re.sub(r"\s+", "", r["text"]) in known or re.sub(r"\s+", "", r["text"].partition("\n\n")[2]) in known for r in found]
    assert len(found) and sum(whole) == len(found)


def test_empty_pages_tables_and_clashing_columns(spark):
    assert pages.extract_text(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, None, None, "x"), (1, None, "", "y"), (1, "u", "<p>a</p>", "z"), (1, "u", "<p>a</p>", "z")]
    wide = spark.createDataFrame(rows, SCHEMA + ", key string").withColumn("part", F.lit(1)).withColumn("own", F.lit("no"))
    assert sorted((r["text"], r["n_chars"]) for r in pages.extract_text(wide).collect()) == [("", 0), ("", 0), ("a", 1), ("a", 1)]
    long = "<article>" + "<p>" + "word " * 200_000 + "</p></article>"
    assert texts(spark, [(5, "https://h.org/a", long)])[5] == ("word " * 200_000).strip()


def test_names_inside_articles():
    kept = """<article><section id="discussion"><p>a</p></section><h2 id="related-work">b</h2><h2 id="search-algorithms">c</h2><section id="navigation"><p>d</p></section>
    <div class="social-history">e</div><h3 id="register">f</h3><div class="alert note">g</div><p>h <math><mi>x</mi><annotation encoding="application/x-tex">\\x</annotation></math></p></article>"""
    assert pages.main_text(pages.lines_of(kept)) == "\n\n".join(["a", "b", "c", "d", "e", "f", "g", "h x"])
    gone = "".join(f"<div {a}>no</div>" for a in ("class='x ad'", "id=comments", "class=share", "class='newsletter'", "role=navigation", "hidden"))
    assert pages.main_text(pages.lines_of(f"<article><p>a</p>{gone}<nav>no</nav></article>")) == "a"
    assert pages.main_text(pages.lines_of("<div><h2 id='search-algorithms'>a</h2><p>b</p></div><div id=search>no</div>")) == "a\n\nb"
