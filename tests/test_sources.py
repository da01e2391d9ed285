import json

from corpusmill.operators import bpe, crawl, stats
from corpusmill.sources.files import read_frequencies, read_settings, read_vocab, reset
from corpusmill.sources.log import stage_log
from corpusmill.schemas import RAW_PAGE


def test_dictionaries(spark, tmp_path):
    (tmp_path / "f.json").write_text(json.dumps({"cd": 1, "ab": 1}))
    (tmp_path / "v.json").write_text(json.dumps(["a", "ab", "a", "b"]))
    assert tuple(bpe.top_pair(bpe.pair_counts(read_frequencies(spark, str(tmp_path / "f.json")))).first())[:2] == ("c", "d")
    assert {r.token for r in read_vocab(spark, str(tmp_path / "v.json")).collect()} == {"a", "ab", "b"}


def test_settings_log_and_reset(spark, tmp_path):
    (tmp_path / "c.yaml").write_text("crawl_seeds:\n  - https://x.example/wiki/A\n")
    assert read_settings(str(tmp_path / "c.yaml")) == {"crawl_seeds": ["https://x.example/wiki/A"]}
    log = stage_log("parse", str(tmp_path / "log"))
    log.info("page %d", 1)
    assert stage_log("parse") is log and "page 1" in (tmp_path / "log" / "parse.log").read_text()
    reset(spark, {str(tmp_path / "raw"): RAW_PAGE})
    assert spark.read.schema(RAW_PAGE).json(str(tmp_path / "raw")).count() == 0


def test_any_predicate(spark):
    pages = spark.createDataFrame([("u", ["abc", None, "xyz"]), ("v", ["q"]), ("u", ["cba"])], "url string, text_list array<string>")
    assert {r.url: r.idxs for r in stats.find_texts_where(pages, lambda t: "b" in t).collect()} == {"u": [0, 0]}


def test_crawl_goes_on(spark):
    out = {"A": "BC", "B": "D", "C": "D", "D": "A"}
    rows = [(f"{crawl.BASE}/wiki/{k}", "".join(f'<a href="/wiki/{x}">x</a>' for x in v), 200) for k, v in out.items()]
    pages = spark.createDataFrame(rows, "url string, text string, http_status int")
    first, queue = crawl.crawl(spark, pages, [f"{crawl.BASE}/wiki/A"], 2)
    rest, left = crawl.crawl(spark, pages, queue, 100, visited=first.select("url"))
    whole, _ = crawl.crawl(spark, pages, [f"{crawl.BASE}/wiki/A"], 100)
    order = lambda df: [r.url for r in df.orderBy("rank").collect()]
    assert order(first) + order(rest) == order(whole) and left.count() == 0
