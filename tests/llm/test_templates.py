from furrow.llm import templates


def texts(page):
    return [t for t, _ in templates.parse(page)[1]]


def test_parts_around_an_article_go():
    page = """<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=x>Menu</a></ul></nav><header>Site</header>
    <div class="cookie-notice">We use cookies</div><article><h1>Head &amp; line</h1><p><b>One<br>two &#233;&nbsp;x<p>Three</b><!-- no --><script>var a="</p>"</script>
    <div class="ad">Buy</div><form><p>Name</form><ul><li>First<li>Second</ul><table><tr><td>a<td>b</table><section id="comments"><p>Nice!</section></article>
    <aside>Side</aside><footer>&copy; me</footer></body>"""
    assert texts(page) == ["Head & line", "One two é x", "Three", "First", "Second", "a", "b"]


def test_pages_without_marks_and_odd_input():
    assert texts("<body><p>Hello<p>wor<i>ld</i></body>") == ["Hello", "world"]
    assert texts("plain & simple") == ["plain & simple"] and texts("<p>a < b</p>") == ["a < b"]
    assert texts("<div hidden>x</div><p aria-hidden=true>y</p><p>z") == ["z"] and texts("<script>only") == []


def test_recurring_elements_of_a_host_go_and_copies_stay(spark):
    rows = [(i, f"http://a.example/{i}", f"<body><div>Follow this site</div><p>Story number {i}</p><div>Last words</div></body>") for i in range(30)]
    rows += [(100 + i, f"http://b.example/{i}", "<body><div>Follow this site</div><p>A copied story</p></body>") for i in range(20)]
    rows += [(200 + i, f"http://c.example/{i}", f"<article><p>Common line</p><p>Own line {i}</p></article>") for i in range(12)]
    rows += [(300, None, "<p>x</p>"), (301, "no host", None), (302, "http://a.example/z", ""), (303, "http://d.example", "<p>" + "long " * 100_000), (303, "http://d.example", "<p>again")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, html string, text string, marked int")
    got = {}
    for r in templates.main_text(df).collect():
        got.setdefault(r["page_id"], []).append(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert all(got[i] == [f"Story number {i}"] for i in range(30))
    assert all(got[100 + i] == ["Follow this site\n\nA copied story"] for i in range(20))
    assert all(got[200 + i] == [f"Own line {i}"] for i in range(12))
    assert got[300] == ["x"] and got[301] == [""] and got[302] == [""] and sorted(map(len, got[303])) == [5, 499_999]
    assert templates.main_text(df.where("false")).collect() == []


def test_what_recurs_goes_on_large_hosts_as_on_small_ones(spark):
    letter, banner = "Sign up for our letter", "We moved to a new house"

    def article(i, extra):
        return f"<article><p>Own line number {i} of many</p><p>Les.</p><p>Its other line {i}</p>{extra}</article>"

    rows = [(i, "http://a.example/x", article(i, f"<div>{letter}</div>" if i < 12 else "")) for i in range(100)]
    rows += [(1000 + i, "http://b.example/x", f"<p>Own line number {i} of many</p>" + (f"<div>{banner}</div>" if i < 5 else "")) for i in range(700)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r["page_id"]: r["text"] for r in templates.main_text(df).collect()}
    # a block of a few letters recurs by chance and stays beside lines of the page's own
    assert all(got[i] == f"Own line number {i} of many\n\nLes.\n\nIts other line {i}" for i in range(100))
    assert all(got[1000 + i] == f"Own line number {i} of many" for i in range(700))
