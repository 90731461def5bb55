"""Template deduction: main text of pages of several layouts, held against how they were made."""

import html
import random
import re

import pytest
from pyspark.sql import functions as F

from siltstone.llm import page_template, queries
from siltstone.llm.page_template import Template
from tests.helpers import SF

PAGES = "page_id long, url string, html string"


def prose(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega", "kappa", "sigma", "theta", "zeta", "iota"]) + str(rng.randrange(40)) for _ in range(n)).capitalize() + "."


def marked(rng, title, blocks, n):
    """An article element between a menu, an advert, comments and a footer; some tags are left open."""
    body = "".join(f"<p>{html.escape(b)}" + "</p>" * rng.randrange(2) for b in blocks)
    menu = "".join(f'<li><a href="/{k}">{prose(rng, 1)}</a></li>' for k in range(rng.randint(3, 7)))
    comments = "".join(f"<p>{prose(rng, 60)}</p>" for _ in range(rng.randrange(6)))
    return f'<html><head><title>{title}</title><script>var x="</p><article>";</script></head><body class="page-{n}"><nav><ul>{menu}</ul></nav><div class="ad">{prose(rng, 30)}</div><article><header><h1>{title}</h1></header>{body}<p>Share this page with friends</p></article><section id="comments">{comments}</section><footer>&copy; me {prose(rng, 5)}</footer></body></html>'


def plain(rng, title, blocks, n):
    """No element tells what the article is: divisions without a telling name, links beside it, a long footer."""
    body = "".join(f"<p>{html.escape(b)}</p>" for b in blocks)
    side = "".join(f'<a href="/{k}">{prose(rng, 6)}</a><br>' for k in range(rng.randint(4, 9)))
    return f'<html><body><div class="x1">{side}</div><div class="x2"><h1>{title}</h1>{body}</div><div class="x3"><p>Some notes on this site that all pages carry</p><p>{prose(rng, 4)}</p></div></body></html>'


def site(host, layout, n, seed, first=0):
    rng, out = random.Random(seed), []
    for k in range(n):
        title, blocks = prose(rng, 4), [prose(rng, rng.randint(15, 60)) for _ in range(rng.randint(1, 6))]
        out.append((first + k, f"http://{host}/{k}", layout(rng, title, blocks, k), "\n".join([title, *blocks])))
    return out


def test_articles_of_two_layouts_and_small_hosts(spark):
    made = site("marked.example", marked, 60, 1) + site("Plain.example:80", plain, 60, 2, 100)
    for k in range(12):
        made += site(f"small{k}.example", marked, 3, 10 + k, 200 + 10 * k)
    table = spark.createDataFrame([r[:3] for r in made], PAGES).withColumns({c: F.lit("other") for c in ("key", "text", "host", "n", "role", "classes")})
    got = {r["page_id"]: r for r in page_template.extract(table.repartition(5)).collect()}
    assert len(got) == len(made)
    for page_id, url, _, text in made:
        assert got[page_id]["text"] == text, page_id
        assert got[page_id]["url"] == url and got[page_id]["n_chars"] == len(text)


def test_the_template_does_the_work(spark):
    """Without the deduced template the layout without telling elements is not told apart, and repeated blocks stay."""
    page = site("plain.example", plain, 1, 3)[0]
    assert page_template.main_text(Template(), page[2]) != page[3]
    table = spark.createDataFrame([r[:3] for r in site("plain.example", plain, 40, 3)], PAGES)
    few = {r["page_id"]: r["text"] for r in page_template.extract(table, 1000).collect()}
    assert few[0] != page[3]
    assert {r["page_id"]: r["text"] for r in page_template.extract(table).collect()}[0] == page[3]


def test_classes_are_ordered_and_nested(spark):
    rng, rows = random.Random(5), []
    for k in range(30):
        items = "".join(f"<li>name {rng.randrange(99)} <i>price</i> {rng.randrange(99)}</li>" for _ in range(rng.randint(1, 5)))
        odd = ["<em>x</em>", "<u>y</u>"]
        rng.shuffle(odd)  # as often as the rest, in no order
        rows.append((k, "http://a.b/", f"<html><body><h1>Top</h1>{''.join(odd)}<ul>{items}</ul><p>end</p></body></html>"))
    pages = page_template.keyed(spark.createDataFrame(rows, PAGES), 20)
    found = page_template.deduced(pages).collect()
    assert len(found) == 1 and found[0]["key"] == "a.b"
    template = Template.read(*found[0][1:])
    sizes = sorted(n for n in template.sizes if n > 1)
    assert len(sizes) == 2  # the page, and the list's items nested in it
    item = page_template.events(rows[0][2])
    kinds = [template.roles[e[0]][0] for e in item if e[0] in template.roles]
    assert kinds[0] == kinds[-1] and len(set(kinds)) == 2 and sorted(set(kinds)) == [min(kinds), max(kinds)] and kinds[0] == min(kinds)
    slots = page_template.Slots(template)
    for _, place in template.tokens(rows[0][2]):
        if place is not None:
            slots.take(*place)
    assert slots.begun == slots.ended and not slots.open
    assert len(json_list(found[0]["dropped"])) >= 2


def json_list(text):
    import json

    return json.loads(text or "[]")


def test_copies_of_one_article_on_a_host_are_kept(spark):
    """All pages of a host carry one article: its blocks repeat like the template, and are kept all the same."""
    text = prose(random.Random(1), 50)
    rows = [(k, "http://one.example/", f"<html><body><nav>menu {k}</nav><article><h1>Title</h1><p>{text}</p></article></body></html>") for k in range(50)]
    assert {r["text"] for r in page_template.extract(spark.createDataFrame(rows, PAGES)).collect()} == {f"Title\n{text}"}


def test_whole_table(spark):
    """The driver's pages: their articles, by cutting them out of the known layout."""
    rows = queries.op12_page_template(spark, SF).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("</?b>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(b for b in blocks if b)


def test_odd_pages(spark):
    long = "<p>" + "wörd &lt; " * 100_000 + "</p>"
    rows = [(1, None, None), (2, "http://a.b", ""), (3, "http://a.b", "just text &amp; more"), (4, "nonsense", "<article>a\t\n b<!-- x --><b>c</b>d</article>"), (5, "http://a.b", "<" * 1000), (6, "http://a.b", f"<article>{long}</article>")]
    rows += [(7, "http://a.b", "<div>" * 5000 + "deep"), (8, "http://a.b", '<a href="never closed'), (9, "http://a.b", "<script>never closed <p>x</p>"), (10, "http://a.b", "<p>1 < 2 &#x41;&notanentity; &copy</p>"), (None, "http://a.b", "<p>no id</p>"), (4, "nonsense", "<article>a\t\n b<!-- x --><b>c</b>d</article>")]
    got = {}
    for least in (1, 20):
        for r in page_template.extract(spark.createDataFrame(rows, PAGES).repartition(4), least).collect():
            got.setdefault(r["page_id"], []).append((least, r["text"]))
    assert sum(map(len, got.values())) == 2 * len(rows)
    texts = {k: {t for least, t in v if least == 20} for k, v in got.items()}
    assert texts[1] == texts[2] == texts[8] == texts[9] == {""}
    assert texts[3] == {"just text & more"} and texts[4] == {"a bcd"}
    assert texts[5] == {"<" * 1000} and texts[7] == {"deep"} and texts[10] == {html.unescape("1 < 2 &#x41;&notanentity; &copy")}
    assert texts[6] == {" ".join(["wörd <"] * 100_000)} and texts[None] == {"no id"}
    assert page_template.extract(spark.createDataFrame([], PAGES)).count() == 0


@pytest.mark.parametrize("cut", range(0, 200, 7))
def test_pages_cut_anywhere(cut):
    page = '<html><body><div class="a" title=\'b > c\'><h1 id=x>Title</h1><ul><li>one<li>two</ul><table><tr><td>1<td>2</table><select><option>x</select></div></body></html>'
    page_template.main_text(Template(), page[:cut])
