from skein.operators import articles as art

PAGE = """<html><body><h1>Title &amp; more</h1><div class="art-info"><span class="time">
<span class="time-date" content="2020-03-01T10:00+01:00">1. března</span></span></div>
<div class="opener">Opener  text</div>
<div id="art-text"><p>First <b>bold</b><br>line<p>Second &lt;x&gt;</p><script>var p = "<p>no</p>";</script></div>
<div id="art-tags"><a href="/t1">one</a><span><a>nested</a></span><a>two</a></div>
<div class="box more-gallery"><b>12 fotek</b></div><div id="moot-linkin"><span>(27 comments)</span></div>
<a score-type='Article' href="/a%20b+c">x</a><a class="big art-link" href="/d">y</a></body></html>"""


def pages(spark):
    return spark.createDataFrame([(1, "u1", PAGE), (2, "u2", "<h1>Bare</h1>"), (3, "u3", None)],
                                 "page_id int, url string, html string")


def test_extract_articles(spark):
    rows = {r.url: r for r in art.extract_articles(pages(spark)).collect()}
    full, bare = rows["u1"], rows["u2"]
    assert full.title == "Title & more"
    assert full.text == ["Opener text", "First bold\nline", "Second <x>"]
    assert full.tags == ["one", "two"]
    assert (full.photo_count, full.comment_count, full.time) == (12, 27, "2020-03-01T10:00+01:00")
    assert (bare.title, bare.text, bare.tags, bare.photo_count, bare.time) == ("Bare", [""], [], 0, None)
    assert rows["u3"].title == ""


def test_extract_links_and_frontier(spark):
    links = art.extract_links(pages(spark))
    assert [tuple(r) for r in links.collect()] == [(1, "/a b+c")]
    both = art.extract_links(pages(spark), art.LINK_SELECTORS)
    assert sorted(r.href for r in both.collect()) == ["/a b+c", "/d"]
    done = spark.createDataFrame([("/d",), ("/d",)], "url string")
    assert [r.href for r in art.frontier(both.unionAll(both), done).collect()] == ["/a b+c"]


def test_clean_articles(spark):
    rows = spark.createDataFrame(
        [("https://s.example/news/1", "2020-01-01T00:00:00"), ("https://s.example/x", "2020-01-01T00:00:00+02:00"),
         ("http://other/news", ""), (None, None)], "url string, time string")
    found = art.normalise_time(art.with_category(rows, "https://s.example/"), "NOW").collect()
    assert [r.category for r in found] == ["news", "x", None, None]
    assert [r.time for r in found] == ["2020-01-01T00:00:00+01:00", "2020-01-01T00:00:00+02:00", "NOW", "NOW"]
    assert art.normalise_time(rows).collect()[3].time.endswith("+00:00")
    lists = spark.createDataFrame([(["a", "b"],), ([],)], "text array<string>")
    assert [r.text for r in art.flatten_text(lists).collect()] == ["a\nb", ""]


def test_replicate_and_export(spark, tmp_path):
    rows = spark.createDataFrame([("a\nb",), ("c",), ("d",)], "text string")
    assert art.replicate(rows, 7).count() == 9
    assert art.replicate(rows.filter("text = 'none'"), 7).count() == 0
    art.export_text(rows, str(tmp_path / "out"), at_least=5)
    assert spark.read.text(str(tmp_path / "out")).count() == 8


def test_append_articles(spark, tmp_path):
    store = str(tmp_path / "store")
    schema = "pos int, url string, title string"
    first = spark.createDataFrame([(0, "u0", "t0"), (1, "u0", "t1"), (2, None, "t2")], schema)
    second = spark.createDataFrame([(0, "u9", "t0"), (1, "u1", "t1"), (2, "u1", "t9"), (3, None, "t5")], schema)
    assert sorted(r.pos for r in art.append_articles(first, store, "pos").collect()) == [0, 2]
    assert [r.pos for r in art.append_articles(second, store, "pos").collect()] == [1]
    assert spark.read.parquet(store).count() == 3


def test_broken_pages_take_time_in_proportion(spark):
    import time

    from skein.functions.html import pick, steps
    path = {"a": steps("article > div p"), "b": steps("span")}

    def seconds(n):
        page = "<article><div>" + "<i>" * n + "<p>x</p></b></u>" * n
        start = time.perf_counter()
        assert len(pick(page, path)["a"]) == n
        return time.perf_counter() - start

    seconds(500)
    assert seconds(16_000) < 40 * max(seconds(2_000), 0.01)


def test_numbers_beyond_an_int_are_null():
    from skein.operators.articles import first_number
    assert [first_number(x) for x in (["99999999999"], ["9" * 5000], ["2147483648"], ["0" * 5000 + "7 of 9"], ["2147483647"], ["no"], [])] == [
        None, None, None, 7, 2147483647, 0, 0]
