from cohortlink.llm import html_text as ht

from .cases import rows


def test_blocks_and_spacing():
    assert ht.render("<p>a<p>b  c\n d<div>e</div>f") == "a\n\nb c d\n\ne\nf"
    assert ht.render("x<br>y<b>z</b> <i> w</i>") == "x\nyz w"
    assert ht.render("<h1>T</h1><pre> k\n   l\n</pre>m") == "T\n\n k\n   l\n\nm"
    assert ht.render("&lt;a&gt; &amp;amp; &eacute;&#8364;") == "<a> &amp; é€"


def test_implied_tags():
    assert ht.render("<ul><li>a<li>b</ul><dl><dt>t<dd>d<dt>u</dl>") == "- a\n- b\n\nt\n  d\nu"
    assert ht.render("<table><tr><td>a<td>bb<tr><td>ccc<td>d</table>") == "a    bb\nccc  d"
    assert ht.render("<title>no</title><body>yes</b></i></p>!") == "yes!"
    assert ht.render("<html><head><meta x><style>s</style><p>shown") == "shown"


def test_visibility():
    page = ("<div hidden>a</div><p style='DISPLAY : none'>b</p><span style=\"visibility:hidden\">c</span><script>if(1<2)d</script>"
            "<!-- e --><template>f</template><input type=hidden value=g><input type=submit value=Go>h<noscript>i</noscript>")
    assert ht.render(page) == "Go h"


def test_lists_and_tables():
    assert ht.render("<ol start=9><li>a<ul><li>b</ul><li>c</ol>") == " 9. a\n    - b\n10. c".replace(" 9. a\n    - b", "9. a\n\n   - b")
    page = "<table><caption>C</caption><thead><tr><th>n<th>long head</thead><tbody><tr><td colspan=2>span<tr><td>é<td>x<br>y</table>"
    assert ht.render(page) == "C\nn  long head\nspan\né  x\n   y"
    assert ht.render("<table><tr><td>a<td><table><tr><td>b<td>c</table></table>") == "a  b  c"


def test_broken_and_deep_pages():
    assert ht.render("<p") == "<p" and ht.render("a < b <3") == "a < b <3"
    assert ht.render("<div>" * 5000 + "deep" + "</div>" * 5000 + "<p>end") == "deep\n\nend"
    assert ht.render("<!-- open") == "" and ht.render("<script>x") == "" and ht.render("<textarea> t </textarea>") == "t"
    assert ht.render(None) == ht.render("") == ""


def test_table_of_pages(spark):
    data = [(1, "u", "<p>x</p>"), (1, "u", "<p>x</p>"), (2, None, None), (None, "u", ""), (3, "u", "word " * 30000)]
    df = spark.createDataFrame(data, "page_id long, url string, html string")
    more = df.selectExpr("page_id", "url", "html", "1 as text", "2 as a", "3 as n_chars").toDF("page_id", "url", "html", "text", "HTML", "n_chars")
    got = rows(ht.extract(more))
    assert got == rows(ht.extract(df)) and len(got) == 5
    assert (1, "x", 1, 1) in got and (2, "", 0, 0) in got and (None, "", 0, 0) in got and (3, ("word " * 30000).strip(), 1, 149999) in got
    assert ht.extract(df.limit(0)).count() == 0
