import pytest

from corpusmill.functions.markup import links, sections
from corpusmill.operators import crawl, parse
from corpusmill.operators.pages import once_each
from corpusmill.sources.fetch import TokenBucket, fetched
from corpusmill.sources.files import paths_of, read_lines, read_pages, write_json_array, write_json_object, write_lines, write_pages
from corpusmill.schemas import SECTION_PAGE


def page(body: str, title: str = '<h1 id="firstHeading">T</h1>') -> str:
    return f'<html><body>{title}<div class="mw-content-ltr mw-parser-output" lang="en">{body}</div></body></html>'


@pytest.mark.parametrize(
    "body, want",
    [
        ("<p>x</p><ol><li>a</li><li class=\"mw-empty-elt\"></li><li>b</li></ol>", ["# T\n\nx\n  1. a\n  2. b\n"]),
        ("<p>x</p><ul><li>a<ul><li>b</li></ul></li><li>c</li></ul>", ["# T\n\nx\n  • a\n  • b\n\n  • c\n"]),
        ("<p>x<sup>2</sup></p>", ["# T\n\nx^2"]),
        ("<p>x<sup class='reference'>[1]</sup><!--note--></p>", ["# T\n\nxnote"]),
        ("<div>no</div><p>x</p><table><tr><td>1</td></tr></table><script>s</script>", ["# T\n\nxs"]),
        ('<p>x</p><div class="mw-heading2"><h2>A</h2></div><p>y</p><div><h2 id="References">R</h2></div><p>z</p>', ["# T\n\nx", "## A\n\ny"]),
        ('<p>x</p><div> <h2 id="References">R</h2></div>', ["# T\n\nx R"]),
        ("<p>a<p>b", ["# T\n\nab"]),
        ("<div>no paragraph</div>", ["# T\n\n"]),
        ("<p>x</p><dl><dd>d</dd></dl><blockquote>q</blockquote><h3>H</h3>", ["# T\n\nxd\n    q\n### H\n"]),
        ('<p><span class="mwe-math-element"><span class="mwe-math-mathml-inline"><annotation>{\\displaystyle x}</annotation></span></span></p>', ["# T\n\n$x$ "]),
        ('<p><span class="mwe-math-element"><annotation>y</annotation></span></p>', ["# T\n\n$$y$$\n"]),
        ('<p><span class="mwe-math-element"></span></p>', ["# T\n\n< --- MISSING MATH --- >"]),
    ],
)
def test_sections(body, want):
    assert sections(page(body)) == want


def test_sections_at_the_edges():
    assert sections('<h1 id="firstHeading">T</h1>') == [] and sections(None) == [] and sections("") == []
    assert sections(page("<p>x</p>", "")) == []
    with pytest.raises(ValueError):
        sections(page("<p>x</p>", ""), strict=True)
    assert sections(page("<p>x<!--n--></p>"), drop_comments=True) == ["# T\n\nx"]
    assert sections(page("<p>" + "<b>" * 5000 + "deep"))[0].endswith("deep")


def test_links():
    a = '<a href="{}" class="{}">x</a>'
    hrefs = [("/wiki/A", ""), ("/wiki/List_of_x", ""), ("/wiki/Main_Page", ""), ("/wiki/File:x", ""), ("/w/A", ""), ("/wiki/B", "mw-redirect"), ("/wiki/A", "")]
    assert links("".join(a.format(*h) for h in hrefs)) == ["/wiki/A", "/wiki/A"]


def web(spark):
    out = {"A": "BC", "B": "DA", "C": "DE", "D": "F", "E": "", "F": "A"}
    rows = [(f"{crawl.BASE}/wiki/{k}", "".join(f'<a href="/wiki/{x}">x</a>' for x in v), 200) for k, v in out.items()]
    return rows


def walk(rows, seeds, most):
    """The crawl one page at a time."""
    known, queue, seen, done = {u: (t, s) for u, t, s in rows}, list(seeds), set(seeds), []
    while queue and len(done) < most:
        url = queue.pop(0)
        text, status = known.get(url, ("", 404))
        if status == 200:
            done.append(url)
            for x in links(text):
                if (u := crawl.BASE + x) not in seen:
                    seen.add(u)
                    queue.append(u)
        elif status == 429:
            break
    return done, queue


@pytest.mark.parametrize("most", [1, 2, 3, 5, 100])
@pytest.mark.parametrize("statuses", [{}, {"C": 500}, {"C": 429}, {"D": 429}])
def test_crawl(spark, most, statuses):
    rows = [(u, t, statuses.get(u[-1], s)) for u, t, s in web(spark)]
    pages = spark.createDataFrame(rows, "url string, text string, http_status int")
    seeds = [f"{crawl.BASE}/wiki/A", f"{crawl.BASE}/wiki/missing"]
    done, queue = crawl.crawl(spark, pages, seeds, most)
    got = [r.url for r in done.orderBy("rank").collect()]
    rest = [r.url for r in queue.orderBy("rank").collect()]
    assert (got, rest) == walk(rows, seeds, most)


def test_seeds_are_needed(spark):
    with pytest.raises(ValueError):
        crawl.crawl(spark, spark.createDataFrame([], "url string, text string, http_status int"), [], 5)


def test_parsed_and_once(spark):
    rows = [(1, "u", page("<p>x</p>"), 5), (1, "u", page("<p>x</p>"), 6), (2, "v", None, 5), (None, "w", "", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, text string, keys int")
    assert {r.page_id: r.text_list for r in parse.parsed(once_each(pages), ["page_id"]).collect()} == {1: ["# T\n\nx"], 2: []}
    assert once_each(pages.limit(0)).count() == 0


def test_bucket():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    bucket = TokenBucket(clock=lambda: now[0], sleep=sleep, shake=lambda a, b: 0.0)
    assert bucket.acquire() == 1.0  # it starts empty
    now[0] += 100
    assert [bucket.acquire() for _ in range(9)] == [0.0] * 9  # ten tokens, the last is not more than one
    assert bucket.acquire() == 0.0 or slept


def test_fetched(spark):
    urls = spark.createDataFrame([("a",), ("b",)], "url string")
    got = {r.url: (r.text, r.http_status) for r in fetched(urls, lambda u: (200, u * 2), rate=1e6).collect()}
    assert got == {"a": ("aa", 200), "b": ("bb", 200)}


def test_files(spark, tmp_path):
    pages = spark.createDataFrame([("u", ["ä", None]), ("v", [])], SECTION_PAGE)
    path = str(tmp_path / "p")
    write_pages(pages, path)
    write_pages(pages.limit(1), path, append=True)
    assert read_pages(spark, path, SECTION_PAGE).count() == 3
    assert read_pages(spark, [path, path], SECTION_PAGE).count() == 6
    with pytest.raises(ValueError):
        paths_of(3)
    write_lines(pages.select("url"), str(tmp_path / "l"))
    assert {r.url for r in read_lines(spark, str(tmp_path / "l")).collect()} == {"u", "v"}
    df = spark.createDataFrame([("b", 2, 1), ("a", 1, 0)], "w string, n int, k int")
    write_json_object(df, str(tmp_path / "o.json"), "w", "n", "k")
    write_json_array(df, str(tmp_path / "a.json"), "w", "k")
    from corpusmill.sources.files import read_json

    assert list(read_json(str(tmp_path / "o.json")).items()) == [("a", 1), ("b", 2)] and read_json(str(tmp_path / "a.json")) == ["a", "b"]


def test_stream(spark, tmp_path):
    from corpusmill.streaming.ingest import append_sections, page_stream

    spark.createDataFrame([("u", page("<p>“x”</p>"))], "url string, text string").write.json(str(tmp_path / "in"))
    stream = append_sections(page_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "check"), once=True)
    stream.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).first().text_list == ['# T\n\n"x"']


def test_pipeline(spark):
    from corpusmill.plans.pipeline import Pipeline

    body = "<p>" + "The mill was old. It was sold in 1900. " * 4 + "</p>"
    pages = spark.createDataFrame([(k, f"u{k}", page(body)) for k in range(3)], "page_id long, url string, text string")
    out = Pipeline(vocab_size=60).run(pages)
    tokens = [t for r in out["tokenized"].collect() for s in r.text_list for x in s for t in x]
    assert out["deduplicated"].count() == 3 and out["vocabulary"].count() <= 60 and tokens
    assert sum(len(r.text_list) for r in out["segmented"].collect()) == 1
