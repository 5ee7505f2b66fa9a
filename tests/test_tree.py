"""Tree construction: the trees that the standard's rules give."""

import random

import pytest

from shelfmark.sources import html, tree
from shelfmark.sources.tree import parse


def shown(node):
    return "".join(k if isinstance(k, str) else f"<{k.tag}>{shown(k)}</{k.tag}>" if k.kids else f"<{k.tag}/>" for k in node.kids)


@pytest.mark.parametrize("page,tree", [
    (None, ""), ("", ""), ("a<br>b</br>c", "a<br/>b<br/>c"), ("</div>x</p>y", "x<p/>y"),
    ("<table><tr><td>a<td>b<tr><td>c</table>d", "<table><tbody><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></tbody></table>d"),
    ("<table><thead><tr><th>h<tbody><tr><td>a<tfoot><tr><td>f</table>", "<table><thead><tr><th>h</th></tr></thead><tbody><tr><td>a</td></tr></tbody><tfoot><tr><td>f</td></tr></tfoot></table>"),
    ("<table><td>a<table><td>b</table>c<td>d</table>", "<table><tbody><tr><td>a<table><tbody><tr><td>b</td></tr></tbody></table>c</td><td>d</td></tr></tbody></table>"),
    ("<table><caption>c<tr><td><p>x<li>y</td></li>z<td>w</table>", "z<table><caption>c</caption><tbody><tr><td><p>x</p><li>y</li></td><td>w</td></tr></tbody></table>"),
    ("<div><table><tr><a>x</a><td>y</table></div>", "<div><a>x</a><table><tbody><tr><td>y</td></tr></tbody></table></div>"),
    ("<table><colgroup><col><col><tr><td>a", "<table><colgroup><col/><col/></colgroup><tbody><tr><td>a</td></tr></tbody></table>"),
    ("<table><tr><td>a<table><tr><td>b</tr></td></table>", "<table><tbody><tr><td>a<table><tbody><tr><td>b</td></tr></tbody></table></td></tr></tbody></table>"),
    ("<ul><li>a<li>b<ul><li>c</ul>d<li>e</ul>", "<ul><li>a</li><li>b<ul><li>c</li></ul>d</li><li>e</li></ul>"),
    ("<p>a<p>b<div>c<p>d</div>e", "<p>a</p><p>b</p><div>c<p>d</p></div>e"), ("<dl><dt>a<dd>b<dt>c</dl>", "<dl><dt>a</dt><dd>b</dd><dt>c</dt></dl>"),
    ("<h1>a<h2>b</h1>c", "<h1>a</h1><h2>b</h2>c"), ("<select><option>a<option>b</select>", "<select><option>a</option><option>b</option></select>"),
    ("<a>x<a>y</a>z", "<a>x</a><a>y</a>z"), ("<b>1<p>2</b>3</p>", "<b>1</b><p><b>2</b>3</p>"), ("<b>1<i>2</b>3</i>4", "<b>1<i>2</i></b><i>3</i>4"),
    ("<p><b>1<p>2", "<p><b>1</b></p><p><b>2</b></p>"), ("<td>no table</td><tr>x", "no tablex"), ("<div/>in<svg><path/><g>y</g></svg>", "<div>in<svg><path/><g>y</g></svg></div>"),
    ("<html><head><title>t</title></head><body><p>x</body></html>", "<title>t</title><p>x</p>"), ("<table><tr><td><b>x<td>y</table>z", "<table><tbody><tr><td><b>x</b></td><td>y</td></tr></tbody></table>z"),
    ("<script>if (a<b) '</td>'</script><div>x", "<script>if (a<b) '</td>'</script><div>x</div>"), ("<table>\n<tr> <td>a</table>", "<table>\n<tbody><tr> <td>a</td></tr></tbody></table>"),
])
def test_trees(page, tree):
    assert shown(parse(page)) == tree


def test_depth_is_no_recursion():
    assert parse("<div>" * 20_000 + "x").content() == "x"
    assert parse("<b>" * 3000 + "<p>x" * 20).content() == "x" * 20


def test_readers_of_pages_that_leave_end_tags_out():
    listing = '<table id=games_table><thead><tr><th>Name<tbody>' + "".join(f'<tr><td><a href=/game/s/n-{i} title={i}>p</a><td class=title>N<b>M</b> {i}<td>c<td>$1.0{i}<td><td>$2.00' for i in (1, 2)) + "</table>"
    assert [(r["id"], r["name"], r["loose"], r["mint"]) for r in html.listing_rows(listing)] == [("1", "NM 1", "1.01", "2.00"), ("2", "NM 2", "1.02", "2.00")]
    detail = "<table><tr><td>UPC:<td>849803097097<tr><td>Series:<td>S</table><p id=used_price>$3.00<div>x"
    found = html.detail(detail)
    assert found["labels"] == {"UPC": "849803097097", "Series": "S"} and found["loose"] == "3.00"
    tiles = "<ul><li data-pid=1><h3>A</h3><span class=category>X</span> <i class=category> Y</i><li data-pid=2><h3>B</ul>"
    assert [(t["pid"], t["title"], t["series"]) for t in html.tiles(tiles)] == [("1", "A", ["X Y"]), ("2", "B", [])]
    field = '<div class=spaced-field><strong>UPC: </strong><span class=ng-binding>1</span></div><div class=spaced-field><strong>UPC:</strong><span class=ng-binding>2</span>'
    assert html.reference_numbers(field) == {"upc": "2"}


def test_regular_pages_have_the_trees_of_html_parser():
    rnd = random.Random(5)
    parts = ["<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", '<td class="title">', "<th>", "<tbody>", "<tfoot>", '<a href="/game/x/y">', "</a>", "<b>", "</b>", "<p>", "</p>", "<br/>", "<LI>", "<ul>", "x", " ", "\n", "&amp;", "&nbsp;", "a > b", "<td\n id=\"q\" hidden>", "<caption>", "<td id=q>", "< b", "<script>", "<!-- c -->", "<h1>", "<select>", "<option>", '<b title="a > b">']
    regular = 0
    for _ in range(3000):
        page = "".join(rnd.choice(parts[:27] if rnd.random() < 0.8 else parts) for _ in range(rnd.randint(1, 25)))
        by_parser = tree.TreeBuilder()
        by_parser.feed(page)
        by_parser.close()
        assert shown(parse(page)) == shown(by_parser.root), page
        regular += tree.TreeBuilder().feed_regular(page)
    assert regular > 1000


def test_pages_of_one_layout_are_parsed_few_times(monkeypatch):
    built = []
    start = tree.TreeBuilder.__init__
    monkeypatch.setattr(tree.TreeBuilder, "__init__", lambda self: (built.append(1), start(self))[1])
    for i in range(1, 200):
        row = f'<tr><td><a href="/game/s{i}/n-{i}" title=" T{i}">p</a></td><td class="title">N <b>M</b> {i}</td><td>c</td><td>${i}.25</td><td> </td><td>$1,{i:03}.00</td></tr>'
        got = html.listing_rows(f'<table id="games_table"><tbody>{row}</tbody></table>')
        assert [(r["id"], r["name"], r["console"], r["loose"], r["complete"], r["mint"]) for r in got] == [(f"T{i}", f"N M {i}", f"s{i}", f"{i}.25", None, f"1{i:03}.00")]
        other = html.listing_rows(f'<table id="games_table"><tbody>{row.replace("/game/", "/offer/")}</tbody></table>')
        assert other == []  # where a link leads is no part of a layout
        found = html.detail(f'<link rel="canonical" href="https://x/{i}"><p id="used_price">$ {i}.5 $ {i}.50</p><table><tr><td>UPC{i % 3}:</td><td> {"none" if i % 2 else i} </td></tr></table>')
        assert found["url"] == f"https://x/{i}" and found["loose"] == f"{i}.50" and found["labels"] == ({} if i % 2 else {f"UPC{i % 3}": str(i)})
    assert len(built) < 20


def test_layouts_take_pages_that_are_not_alike_one_by_one():
    row = lambda text: f'<table id="games_table"><tbody><tr><td><a href="/game/a/b">{text}</a></td><td class="title">{text}</td></tr></table>'
    for text in ("x", "a > b", "", " ", "&nbsp;", "&lt;td&gt;", "1", "<i>x</i>", "<!-- c -->x", "1 < 2"):
        for _ in range(3):
            assert html.listing_rows(row(text)) == [{"id": "b", "name": "" if text == "&nbsp;" else {"&lt;td&gt;": "<td>", "<i>x</i>": "x", "<!-- c -->x": "x"}.get(text, text.strip()), "console": "a", "href": "https://www.pricecharting.com/game/a/b", "loose": None, "complete": None, "mint": None}]


@pytest.mark.parametrize("name", ["q_listing_rows", "q_detail_prices", "q_detail_fields", "q_open_listing", "q_open_detail", "q_sql_listing"])
def test_whole_pages_are_not_shuffled(spark, name):
    from shelfmark.plans import catalog_queries, page_queries  # noqa: F401

    plan = catalog_queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan()
    moved = [str(plan.apply(0).getClass())]
    for i in range(60):
        try:
            node = plan.apply(i)
        except Exception:
            break
        if node is None:
            break
        if "Repartition" in node.nodeName():
            moved.append(node.output().mkString(","))
    assert len(moved) == 2 and "html" not in moved[1]
