"""Operators against brute force and on odd inputs."""

import hashlib
import random

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from loadlens.llm import decontaminate, exact_dedup, grouping_sort, html_extract, mixing, quality, simhash, suffix_dedup, token_counts, toxicity, url_filter
from loadlens.llm.common import located
from loadlens.llm.components import connected_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, loc string, kept boolean, score double, fp long, o string"
LABELS = "doc_id long, quality int, toxic int"


def odd_docs(spark):
    """NULLs, empty and long texts, ties, repeated rows, clashing column names."""
    long = "word " * 5_000 + "end"
    texts = [
        (1, "One two  three"), (2, "One two three"), (3, "One two three "), (4, None), (5, ""), (5, ""), (None, "no id"), (None, "no id"),
        (6, long), (7, long), (8, "\x0b\t "), (9, "é" * 60 + " tail"), (10, "é" * 60 + " tail"), (11, None),
    ]
    rows = [(i, t, None, "a" if n % 3 else None, None, "x", None, 0.5, 7, "o") for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), LABELS)


def test_exact_dedup_odd_rows(spark):
    got = exact_dedup.exact_dedup(located(odd_docs(spark), "at"), "at").collect()
    assert len(got) == 14
    groups = {}
    for r in got:
        groups.setdefault(r.text_sha256, []).append(r)
    for rows in groups.values():
        assert sum(r.kept for r in rows) == 1 and {r.group_size for r in rows} == {len(rows)}
    by_id = {r.doc_id: r for r in got if r.doc_id}
    assert by_id[2].keep_id == 1 and by_id[3].keep_id == 1  # most code points, then smallest id
    assert by_id[4].keep_id == 8  # blanks count as the empty text, and the longest original stays
    assert by_id[7].keep_id == 6


def test_exact_dedup_resolves_lying_digests(spark):
    rng = random.Random(3)
    rows = [(i, str(rng.randint(0, 60)) + " " * rng.randint(0, 2)) for i in range(400)]
    docs = located(spark.createDataFrame(rows, "doc_id long, text string"))
    plain = {r.doc_id: r for r in exact_dedup.exact_dedup(docs).collect()}
    weak = {r.doc_id: r for r in exact_dedup.exact_dedup(docs, digest_bits=8).collect()}
    assert plain.keys() == weak.keys()
    assert all((plain[i].keep_id, plain[i].group_size, plain[i].kept) == (weak[i].keep_id, weak[i].group_size, weak[i].kept) for i in plain)


def test_stages_keep_columns_and_take_empty_tables(spark):
    bench = spark.createDataFrame([(1, "One two three")], "item_id long, text string")
    full = odd_docs(spark)
    for stage in (
        exact_dedup.drop_copies,
        simhash.drop_near_copies,
        lambda d: decontaminate.drop_contaminated(d, bench),
        lambda d: quality.drop_rejected(d, labels(spark)),
    ):
        assert stage(full).columns == full.columns and stage(full).count() > 0
        assert stage(empty_docs(spark)).columns == full.columns and stage(empty_docs(spark)).count() == 0
    assert mixing.mix_sources(empty_docs(spark)).count() == 0
    kept = {r.doc_id for r in decontaminate.drop_contaminated(full, bench).collect()}
    assert not kept & {1, 2, 3} and {4, 5, 6, 7, 8, 9, 10, 11, None} <= kept


def brute_fingerprint(text):
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    ones = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def components_of(values):
    parent = {v: v for v in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if bin(a ^ b).count("1") <= 2:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


@pytest.mark.parametrize("paired", [4, 2, 1000])
def test_links_of_dense_and_sparse_fingerprints(spark, paired):
    rng = random.Random(5)
    values = {0, 1, (1 << 63) - 1}
    for _ in range(25):
        centre = rng.getrandbits(63)
        values.add(centre)
        for _ in range(rng.choice([0, 1, 12])):
            values.add(centre ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) ^ (rng.random() < 0.3) * (1 << rng.randrange(63)))
    values = sorted(values)
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    edges = simhash.links(frame, paired)
    assert all(bin(r.a ^ r.b).count("1") <= 2 for r in edges.collect())
    roots = {r.node: r.root for r in connected_components(edges).collect()}
    assert {v: roots.get(v, v) for v in values} == components_of(values)


def test_near_duplicates_odd_rows(spark):
    got = simhash.near_duplicates(located(odd_docs(spark), "at"), "at").collect()
    assert len(got) == 14
    by_id = {r.doc_id: r for r in got if r.doc_id}
    assert by_id[4].fp == 0 and by_id[4].component_id == by_id[11].component_id == 4
    for i, text in [(1, "One two  three"), (6, "word " * 5_000 + "end"), (9, "é" * 60 + " tail")]:
        assert by_id[i].fp % (1 << 64) == brute_fingerprint(text)
    assert by_id[7].component_id == 6


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    roots = {r.node: r.root for r in connected_components(edges).collect()}
    assert {roots[i] for i in range(201)} == {0} and roots[501] == 500
    assert connected_components(edges.limit(0)).count() == 0


def test_decontamination_against_brute_force_and_in_blocks(spark):
    rng = random.Random(2)
    word = lambda: rng.choice(["a", "b", "C", "Ü", "d1"])
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 4, 12, 14])))) for i in range(12)] + [(90, "!!"), (91, None), (92, "zzz")]
    texts = [(i, rng.choice([" ", ", ", "\n"]).join(word() for _ in range(rng.choice([0, 3, 40])))) for i in range(60)] + [(99, None)]
    docs = located(spark.createDataFrame(texts, "doc_id long, text string"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    split = lambda t: regex.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c < "\x80" else c for c in t or ""))
    expected = {}
    for i, t in texts:
        words, hit, found = split(t), set(), set()
        for k, item in items:
            own = split(item)
            size = min(10, len(own))
            for s in range(len(own) - size + 1 if own else 0):
                for at in range(len(words) - size + 1):
                    if words[at : at + size] == own[s : s + size]:
                        hit |= set(range(at, at + size))
                        found.add(str(k))
        expected[i] = (len(words), len(hit), sorted(found))
    for block in (1 << 20, 40):
        got = decontaminate.scan(docs, bench, block_bytes=block).collect()
        assert {r.doc_id: (r.n_words, r.n_hit, list(r.items)) for r in got} == expected
    one = decontaminate.scan(located(spark.createDataFrame([(1, "Ä, x zzz; y ZZZ zzz.")], "doc_id long, text string")), bench).first()
    assert [("Ä, x zzz; y ZZZ zzz."[s.start : s.end]) for s in one.spans] == ["zzz", "ZZZ zzz"]
    assert decontaminate.scan(docs, bench.limit(0)).agg(F.sum("n_hit")).first()[0] == 0


def test_suffix_array_and_matches():
    rng = random.Random(1)
    for _ in range(400):
        symbols = [rng.randrange(rng.choice([1, 2, 4, 20])) for _ in range(rng.randrange(30))]
        array = np.array(symbols, dtype=np.int64)
        assert grouping_sort.suffix_array(array) == sorted(range(len(symbols)), key=lambda i: symbols[i:])
        expected = []
        for i in range(len(symbols)):
            best = 0
            for j in range(i):
                h = 0
                while i + h < len(symbols) and symbols[i + h] == symbols[j + h]:
                    h += 1
                best = max(best, h)
            expected.append(best)
        assert grouping_sort.longest_earlier_match(array) == expected


def brute_repeats(rows):
    seen, found = set(), []
    for i, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - 99):
            w = raw[s : s + 100]
            if w in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(w)
        left = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(1 for j in range(len(raw)) if gone[j] and (j == 0 or not gone[j - 1]))
        found.append((i, len(raw), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    return found


@pytest.mark.parametrize("group", [100, 2])
def test_suffix_dedup_against_brute_force(spark, group):
    rng = random.Random(8)
    passages = ["".join(rng.choice("abcdé ") for _ in range(rng.choice([40, 99, 130, 400]))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.6 else "".join(rng.choice("xyz ") for _ in range(rng.randrange(80))) for _ in range(4)]
        text = "".join(parts)
        if rng.random() < 0.5 and text:
            at = rng.randrange(len(text))
            text = text[:at] + "#" + text[at + 1 :]
        rows.append((i, text))
    rows += [(60, None), (61, ""), (62, "a" * 700), (63, "a" * 300), (64, "a" * 300), (65, "\0" * 150), (66, "\0" * 151)]
    docs = located(spark.createDataFrame(rows, "doc_id long, text string"))
    got = suffix_dedup.remove_repeats(docs, sorted_group=group).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_repeats(rows)


@pytest.mark.parametrize("group", [100, 2])
def test_suffix_dedup_rows_of_one_id(spark, group):
    """Earlier is a smaller id or the same row: rows that come twice, or share an id, lose nothing to one another."""
    rng = random.Random(5)
    passages = ["".join(rng.choice("abcdé ") for _ in range(rng.choice([99, 130, 400]))) for _ in range(5)] + ["z" * 180]
    rows = []
    for i in range(50):
        parts = [rng.choice(passages) if rng.random() < 0.6 else "".join(rng.choice("xyz ") for _ in range(rng.randrange(80))) for _ in range(4)]
        rows.append((i // rng.choice([1, 2, 9]), "".join(parts)))
    rows += [*rows[::7], (None, rows[3][1]), (None, rows[3][1] + passages[0]), (None, rows[3][1] + "end")]
    order = [float("inf") if i is None else i for i, _ in rows]
    least = {}
    for place, (_, text) in zip(order, rows):
        raw = text.encode()
        for s in range(len(raw) - 99):
            least[raw[s : s + 100]] = min(place, least.get(raw[s : s + 100], place))
    wanted = []
    for place, (i, text) in zip(order, rows):
        raw, own = text.encode(), set()
        gone = bytearray(len(raw))
        for s in range(len(raw) - 99):
            w = raw[s : s + 100]
            if least[w] < place or w in own:
                gone[s : s + 100] = b"\1" * 100
            own.add(w)
        left = bytes(b for b, g in zip(raw, gone) if not g)
        wanted.append((i, len(raw), sum(gone), len(gone.replace(b"\0", b" ").split()), hashlib.sha256(left).hexdigest()))
    docs = located(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    got = suffix_dedup.remove_repeats(docs, sorted_group=group).collect()
    assert sorted(map(str, wanted)) == sorted(str((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in got)


def test_suffix_dedup_odd_rows(spark):
    got = suffix_dedup.remove_repeats(located(odd_docs(spark), "at"), "at").collect()
    by_id = {r.doc_id: r for r in got if r.doc_id}
    assert len(got) == 14 and by_id[7].n_removed == by_id[7].n_bytes and by_id[9].n_removed == 118  # repeats itself from its second letter
    assert 0 < by_id[6].n_removed < by_id[6].n_bytes  # repeats itself
    assert suffix_dedup.remove_repeats(located(empty_docs(spark), "at"), "at").count() == 0


def test_mixing_rates_and_draws(spark):
    rows = [(i, "x" * 100, "a") for i in range(3000)] + [(i, "x" * 100, "b") for i in range(3000, 3300)] + [(4000, "x" * 10, None), (4001, None, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    rates = {r.source: r.rate for r in mixing.source_rates(docs, {"a": 1.0, "b": 1.0}).collect()}
    assert rates["a"] == pytest.approx(330010 / 2 / 300000) and rates["b"] == pytest.approx(330010 / 2 / 30000)
    assert rates[None] == 0 and rates["c"] == 1
    counts = {r.source: r.n for r in mixing.mix_sources(docs, {"a": 1.0, "b": 1.0}).groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert abs(counts["a"] - 1650) < 200 and abs(counts["b"] - 1650) < 200 and None not in counts
    big = mixing.mix_sources(docs.where("source = 'b'"), size=900.0).groupBy("doc_id").count()
    mean, spread = big.agg(F.avg("count"), F.var_pop("count")).first()
    assert abs(mean - 900) < 10 and 600 < spread < 1300  # drawn in parts, still Poisson
    once, again = (mixing.mix_sources(docs.repartition(n)).collect() for n in (2, 5))
    assert once == again and [r.mix_key for r in once] == sorted(r.mix_key for r in once)


def test_decoder_and_restorer():
    text = "the idiot was a moron and a clown in the stupid trash with scum and a pathetic loser " * 20
    counts = np.zeros((32, 32, 32))
    s = [0, 0, *text.encode().translate(toxicity._SYMBOL), 0]
    for a, b, c in zip(s, s[1:], s[2:]):
        counts[a, b, c] += 1
    model = np.log((counts + 0.05) / (counts.sum(axis=2, keepdims=True) + 1.6))
    restorer = toxicity.Restorer(model)
    for disguised, plain in [("1d10t", "idiot"), ("m0r0n", "moron"), ("$tup1d", "stupid"), ("l0s3r", "loser"), ("iiiidiot", "idiot"), ("cl*wn", "clown")]:
        assert plain.encode() in toxicity.restored_words(restorer.restore(f"you {disguised}, you"))
    for spaced in ("you i d i o t you", "you i.d.i.o.t you", "you s-c-u-m"):
        assert {b"idiot", b"scum"} & set(toxicity.restored_words(restorer.restore(spaced)))
    assert restorer.restore("Plain text, as it is.\n") == b"plain text, as it is.\n"
    assert restorer.restore("") == b""


def test_toxicity_finds_disguised_words(spark):
    rng = random.Random(4)
    # Words with a common run of consonants let the model learn; "grumblo" and "snarkel" are the bad ones.
    good = ["".join(rng.choice(["ka", "le", "mi", "to", "ru", "sen"]) for _ in range(rng.randint(2, 3))) for _ in range(200)]
    rows, marks = [], []
    for i in range(600):
        words = rng.choices(good, k=30)
        bad = i % 4 == 0
        if bad:
            words[5:5] = rng.sample(["grumblo", "snarkel"], 1)
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(bad)))
    rows += [(1000, "kale gr*mblo toru"), (1001, "mito sn4rk3l toru"), (1002, "lemi g r u m b l o toru"), (1003, "lemi toru"), (1004, None)]
    got = toxicity.score(located(spark.createDataFrame(rows, "doc_id long, text string")), labels(spark, marks)).collect()
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].predicted for i in (1000, 1001, 1002, 1003, 1004)] == [1, 1, 1, 0, 0]
    assert all(by_id[i].predicted == t for i, _, t in marks)
    assert toxicity.score(located(empty_docs(spark), "at"), labels(spark), "at").count() == 0
    assert {r.score for r in toxicity.score(located(odd_docs(spark), "at"), labels(spark), "at").collect()} == {0.5}


PAGE = """<html><head><title>T</title><style>x</style></head><body><header><h2>Site</h2></header>
<nav><ul><li><a href=/>Home</a></ul></nav><div class="cookie-notice">We use cookies</div><article><h1>A &amp; B</h1>
<p>One&nbsp;<b>bold</b>
 text<p>Two<br>lines<script>var a="</p>";</script><div class="ad">Buy</div><ul><li>x<li>y</ul><table><tr><td>1<td>2</table></article>
<aside>Side</aside><section class="comments"><p>Nice!</p></section><form><p>Mail</p></form><footer>&copy; me</footer>"""


def test_html_blocks():
    kept = [t for _, role, t in html_extract.blocks_of(PAGE) if role >= 0]
    assert kept == ["A & B", "One bold text", "Two lines", "x", "y", "1", "2"]
    assert html_extract.blocks_of("") == [] and html_extract.blocks_of("<p>a < b & c &am")[0][2] == "a < b & c &am"
    assert [t for _, _, t in html_extract.blocks_of("<p>cut <b")] == ["cut"]


def test_style_tree_finds_unmarked_boilerplate(spark):
    pages = [(i, f"http://h.org/{i}", f"<body><div class=top><p>Same on all</p></div><div class=text><p>Own {i} {i * 7}</p><p>More {i * 3}</p></div></body>") for i in range(80)]
    pages += [(100, None, None), (101, "x", ""), (102, "http://other.org/", PAGE)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[5] == "Own 5 35\nMore 15" and got[100] == got[101] == "" and got[102].startswith("A & B\nOne bold text")
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_url_rules_and_trees(spark):
    urls = [
        "http://A.Example.NET/en/1?x=1#f", "https://example.net/de/2", "http://example.net", "ftp://b.example.com/de/3", "http://x.org/fr/4",
        "http://notnet/1", "no scheme", None, "", "http://m.casino-win.example.org/en/1", "http://example.org/en?a=b&c=d",
    ]
    more = [f"http://www.site{i}.example.org/en/{i}" for i in range(300)] + [f"http://m.cheap-pills.example.com/en/{i}" for i in range(40)]
    frame = spark.createDataFrame(list(enumerate(urls + more)), "page_id long, url string")
    got = {r.page_id: r for r in url_filter.judge(frame).collect()}
    assert (got[0].host, got[0].path, got[0].rule, got[0].verdict) == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert [got[i].rule for i in range(11)] == ["example.net/en/", "net/", None, "example.com/de/", "org/fr/", None, None, None, None, None, None]
    assert [got[i].verdict for i in (1, 3, 4)] == ["block", "block", "allow"]
    assert all((got[i].host, got[i].path) == ("", "") for i in (6, 7, 8)) and got[10].path == "/en"
    assert got[9].verdict == "block" and {got[11 + i].verdict for i in range(300)} == {"allow"}
    assert url_filter.judge(frame.limit(0)).count() == 0


def test_token_trees_follow_edits():
    encoding = token_counts.encoder()
    rng = random.Random(6)
    for _ in range(150):
        alphabet = rng.choice(["ab c", "a  b\n.", "aé1 '", "word "])
        text = "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 3, 200, 900])))
        tree = token_counts.build_tree(text, encoding, points=20)
        assert tree.tokens == len(encoding.encode_ordinary(text)) and sum(tree.lengths) == len(text)
        edits, at = [], 0
        while at <= len(text) and len(edits) < 6:
            start = at + rng.randrange(60)
            stop = start + rng.randrange(4)
            if stop > len(text):
                break
            edits.append((start, stop, rng.choice(["", " x", "'s", "\n\n", "long new text of words"])))
            at = stop + 1
        new = text
        for a, b, put in reversed(edits):
            new = new[:a] + put + new[b:]
        assert tree.edit(text, edits, encoding) == new
        assert tree.tokens == len(encoding.encode_ordinary(new)) and sum(tree.lengths) == len(new)
        again = [(0, min(2, len(new)), "Q")]
        assert tree.edit(new, again, encoding) == "Q" + new[min(2, len(new)) :]
        assert tree.tokens == len(encoding.encode_ordinary("Q" + new[min(2, len(new)) :]))


def test_token_counts_after_masking(spark):
    text = "plain words here " * 400 + "mail a.b@c.org now, call +49 30 1234567 " + "more words there " * 400
    rows = [(1, text), (2, None), (3, ""), (4, "no edit")]
    got = {r.doc_id: r for r in token_counts.counts_after_masking(located(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    encoding = token_counts.encoder()
    masked = text.replace("a.b@c.org", "<EMAIL>").replace("+49 30 1234567", "<NUMBER>")
    assert got[1].n_tokens == len(encoding.encode_ordinary(text)) and got[1].n_tokens_after == len(encoding.encode_ordinary(masked))
    assert got[1].n_edits == 2 and 1 <= got[1].n_reencoded <= 2 < got[1].n_leaves
    assert (got[2].n_tokens, got[3].n_tokens, got[4].n_edits) == (0, 0, 0)


def test_quality_rules_learn_and_fall_back(spark):
    rng = random.Random(9)
    rows, marks = [], []
    for i in range(400):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(40)]
        good = i % 3 > 0
        rows.append((i, " ".join(words) if good else " ".join(w.upper() + "!!" for w in words)))
        marks.append((i, int(good), 0))
    rows += [(1000, None), (1001, "")]
    docs = located(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: r for r in quality.score(docs, labels(spark, marks)).collect()}
    assert all(got[i].predicted == q for i, q, _ in marks) and {0 <= r.score <= 1 for r in got.values()} == {True}
    assert {r.score for r in quality.score(docs, labels(spark)).collect()} == {0.5}
    assert quality.score(located(empty_docs(spark), "at"), labels(spark), "at").count() == 0
