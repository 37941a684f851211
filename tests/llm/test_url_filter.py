"""URL filter: rules against SQL, trees judged on hosts they never saw, odd rows."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from loadlens.llm import url_filter

FOLDER = "/root/testdata/sf0.01"
RULES_SQL = r"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u),
r(verdict, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fits AS (
  SELECT page_id, h || r.p AS rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(h || r.p) DESC) AS k
  FROM p JOIN r ON (host = h OR host LIKE '%.' || h) AND starts_with(path, r.p))
SELECT p.page_id, host, path, rule, verdict FROM p LEFT JOIN fits ON p.page_id = fits.page_id AND k = 1
"""


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not there")
def test_host_path_and_rule_as_in_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{FOLDER}/pages.parquet'")
    truth = {r[0]: r[1:] for r in con.execute(RULES_SQL).fetchall()}
    got = {r.page_id: r for r in entry.queries()["op6_url_filter"](spark, FOLDER).collect()}
    assert {i: (r.host, r.path, r.rule) for i, r in got.items()} == {i: t[:3] for i, t in truth.items()}
    assert all(got[i].verdict == t[3] for i, t in truth.items() if t[2] is not None)
    assert {r.verdict for r in got.values()} == {"allow", "block"}


def _spam_pages(spark):
    urls = [f"http://offer-{i}-{i * 7}.example.com/en/{k}?a={k}" for i in range(20) for k in range(10)]
    urls += [f"http://paper{'abcdefghij'[i % 10]}{'klmno'[i % 5]}.example.com/en/{k}" for i in range(40) for k in range(10)]
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), urls


def test_trees_find_hosts_they_never_saw(spark):
    pages, urls = _spam_pages(spark)
    labelled = spark.createDataFrame([(u, int("offer" in u)) for u in urls], "url string, label int")
    judged = url_filter.judge(pages, seeds=(), labelled=labelled)
    quality = url_filter.held_out_quality(judged).first()
    assert quality.n == 600 and quality.positives == 200
    assert quality.precision > 0.95 and quality.recall > 0.95


def test_own_label_does_not_reach_the_score(spark):
    """Another label for all urls of one host changes no score of that host."""
    pages, urls = _spam_pages(spark)
    host = "http://offer-3-21.example.com/"
    score = []
    for turned in (False, True):
        labels = [(u, int("offer" in u) if not (turned and u.startswith(host)) else 0) for u in urls]
        judged = url_filter.judge(pages, seeds=(), labelled=spark.createDataFrame(labels, "url string, label int"))
        score.append({r.page_id: r.score for r in judged.where("host = 'offer-3-21.example.com'").collect()})
    assert len(score[0]) == 10 and score[0] == score[1] and min(score[0].values()) >= 0.5


def test_odd_urls(spark):
    long = "http://a.example.org/" + "x/" * 100_000 + "?" + "k=v&" * 1_000
    rows = [(1, None, "h", 1.0), (1, None, "h", 1.0), (None, "", "h", 1.0), (2, long, None, None), (3, "http://a-b.example.org", "h", 0.0), (3, "http://a-b.example.org", "h", 0.0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, label double")
    labelled = spark.createDataFrame([("http://a-b.example.org", 1), ("http://a-b.example.org", 0), (None, 1), (long, None)], "url string, label int")
    got = url_filter.judge(pages, labelled=labelled).collect()
    assert len(got) == 6 and all(r.verdict in ("allow", "block") and 0 <= r.score <= 1 for r in got)
    assert sum(r.label == 1 for r in got) == 2 and {r.path for r in got if r.page_id == 2} == {"/" + "x/" * 100_000}
    assert url_filter.judge(pages.limit(0)).count() == 0
    nothing = url_filter.held_out_quality(url_filter.judge(pages.limit(0))).first()
    assert nothing.n == 0 and nothing.recall is None
