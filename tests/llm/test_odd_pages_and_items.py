"""Pages whose names mislead, long runs of letters beside a mail sign, benchmark items without id."""

import random
import re
import time

import pytest

from loadlens.llm import decontaminate, html_extract, token_counts
from loadlens.llm.common import located


@pytest.mark.parametrize(
    "page,kept",
    [
        ('<article><p>one <svg viewBox="0 0 1 1"/> two</p><p>three</p></article>', ["one two", "three"]),
        ("<article><p>a</p><video-player src='x'><p>b</p></video-player><object-card><p>c</p></object-card></article>", ["a", "b", "c"]),
        ('<article class="post has-sidebar"><p>kept</p></article>', ["kept"]),
        ('<body class="header-fixed no-menu"><main><p>kept</p></main></body>', ["kept"]),
        ('<main><section class="related-work"><p>kept</p></section></main>', ["kept"]),
        ('<div class="search-results-article"><p>kept</p></div>', ["kept"]),
        ('<main><div class="ad-hoc"><p>kept</p></div></main>', ["kept"]),
        ("<article><svg><text>no</text></svg><p>kept</p></article>", ["kept"]),
        ('<article><p>kept</p><div class="site-footer">no</div><ul class="comment-list"><li>no</li></ul><div id="cookie-banner">no</div><div class="ad-slot">no</div></article>', ["kept"]),
        ("<main><nav>no</nav><p>kept</p><form>no</form><aside>no</aside></main>", ["kept"]),
    ],
)
def test_names_that_mislead(spark, page, kept):
    frame = spark.createDataFrame([(1, "http://a.example/x", page)], "page_id long, url string, html string")
    assert html_extract.extract(frame).first().text == "\n".join(kept)


def test_mail_spans_are_those_of_the_pattern():
    pattern = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
    rng = random.Random(1)
    for _ in range(20_000):
        text = "".join(rng.choice("ab@@..-_ é") for _ in range(rng.randint(0, 14)))
        assert [m.span() for m in pattern.finditer(text)] == list(token_counts.mail_spans(text))
    begin = time.perf_counter()
    assert len(list(token_counts.mail_spans("a" * 3_000_000 + " x@y.z " + "@" * 200_000))) == 1
    assert time.perf_counter() - begin < 5


def test_items_without_id_hit_words_but_are_not_listed(spark):
    ten = "a b c d e f g h i j"
    docs = located(spark.createDataFrame([(1, f"x {ten} y"), (2, "k l m"), (3, "z")], "doc_id long, text string"))
    bench = spark.createDataFrame([(None, ten), ("q", "k l m"), ("r", ten + " y"), (None, None), ("n", None)], "item_id string, text string")
    for size in (decontaminate.BLOCK_BYTES, 20):
        got = {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in decontaminate.scan(docs, bench, block_bytes=size).collect()}
        assert got == {1: (12, 11, ["r"]), 2: (3, 3, ["q"]), 3: (1, 0, [])}
    only = decontaminate.scan(docs, bench.where("item_id is null")).where("doc_id = 1").first()
    assert (only.n_hit, list(only["items"])) == (10, [])
