import time

from tributary.llm import html


def test_blocks_lists_and_entities():
    got = html.render("<html><head><title>no</title><style>p{}</style></head><body><h1>A &amp; B</h1><p>One<b> two<br>three<p>Four\n  five"
                      "<script>var a='</p>'</script><ul><li>x<li>y<ol start=3><li>p<li value=7>q</ol></ul>tail")
    assert got == "A & B\n\nOne two\nthree\n\nFour five\n\n- x\n- y\n  3. p\n  7. q\n\ntail"


def test_hidden_parts():
    got = html.render("<div hidden>a</div><p style='display : none'>b</p><template>c</template><noscript>d</noscript>"
                      "<details><summary>S</summary>e</details><details open><summary>T</summary>f</details><!-- g --><dialog>h</dialog>i")
    assert got == "S\nT\nf\ni"


def test_formulas_diagrams_and_choices():
    got = html.render("<p>If <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow><annotation>x=1 TeX</annotation></semantics></math> then"
                      "<svg viewBox='0 0 1 1'><title/><title>t</title><defs><text>d</text></defs><metadata>m</metadata><g>loose<path d='M0'/><text x='1'>Boiler "
                      "<tspan>A</tspan></text><text display='none'>n</text><text>Pump</text></g><desc>e</desc></svg> end.")
    assert got == "If x=1 then Boiler A Pump end."
    assert html.render("<svg><foreignObject><p>in</p></foreignObject></svg><svg><path><p>after</p>") == "in\n\nafter"
    assert html.render("Size <select><option>S<option selected>M<option>L</select> Colour <select><option disabled>pick<optgroup label=g><option>red"
                       "<option>blue</optgroup></select> Tags <select multiple><option>a<option label='b2'>b</select><select hidden><option>z</select>") == "Size M Colour red Tags a b2"
    assert html.render("<desc>c</desc><select></select><svg/>d") == "c d"


def test_tables_align():
    got = html.render("<table><caption>Cap</caption><tr><th>Name<th>N<tr><td>long name<td>1<tr><td colspan=2>all across"
                      "<tr><td rowspan=2>two<td>a<tr><td>b</table>")
    assert got.split("\n") == ["Cap", "Name       N", "long name  1", "all across", "two        a", "           b"]
    nested = html.render("<table><tr><td><table><tr><td>a<td>b</table><td>c</table>")
    assert nested == "a  b  c"


def test_preformatted_and_rules():
    assert html.render("a<pre>\n x  y\n   z</pre>b<hr>c") == "a\n\n x  y\n   z\n\nb\n\n----\n\nc"


def test_broken_markup():
    assert html.render("") == ""
    assert html.render("a < b && c <3") == "a < b && c <3"
    assert html.render("<p>x</div></span>y</p></p>z") == "xy\n\nz"
    assert html.render("<!-- never closed <p>x") == ""
    assert html.render("<b>" * 5000 + "deep") == "deep"
    assert html.render("<div>" * 5000 + "deep") == "deep"
    assert html.render('<a title="x>y">k</a>') == "k"


def test_deep_and_unclosed_markup_takes_linear_time():
    start = time.perf_counter()
    assert html.render("<div>" * 100_000 + "deep") == "deep"
    assert html.render("<select><option>a" * 5000) == "a " * 4999 + "a"
    assert html.render("<b>" * 50_000 + "</i>" * 50_000 + "x") == "x"
    assert html.render("x" + "<a " * 50_000).startswith("x<a")
    assert html.render("<p><table><tr><td>" + "<div>" * 50_000 + "x") == "x"
    assert html.render("x>" + "<!-- " * 20_000) == "x>"
    assert html.render("<select><option>a<select><option>b<option selected>c</select>d") == "a c d"
    assert time.perf_counter() - start < 30


def test_extract_edge_rows(spark):
    rows = [(1, None, "t"), (2, "", "u"), (None, "<p>x", None), (4, "<p>" + "word " * 100_000, "v"), (2, "", "u")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = html.extract(pages)
    assert got.columns == ["page_id", "text"]
    out = {(r["page_id"], None if r["text"] is None else len(r["text"])) for r in got.collect()}
    assert out == {(1, None), (2, 0), (None, 1), (4, 499_999)} and got.count() == 5
    assert html.extract(pages.limit(0)).count() == 0
