"""WARC archives, HTML extraction and nearest neighbours."""

import hashlib
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.llm import ann, html, warc


def test_warc_round_trip(spark):
    rng = random.Random(4)
    big, dup = "é" * 9000, "x" * 999 + "é"
    rows = [(1, "http://a/x y", big), (2, None, None), (3, "http://b\r\nX: y", ""), (5, "u", dup), (9, "u2", dup), (7, "u3", dup), (4, "s", "small"), (6, "s", "small"), (None, "n", dup), (9, "u2", dup)]
    rows += [(100 + i, f"http://h/{i}", "".join(rng.choice("ab<>\r\n é") for _ in range(rng.randint(0, 5000)))) for i in range(40)]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    table = warc.write_archives(pages, chunk_bytes=1000)
    got = sorted(map(tuple, warc.read_archives(table).collect()), key=repr)
    want = []
    for i, _, text in rows:
        raw = (text or "").encode()
        refers = 9 if i in (5, 7) else None
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if refers else "response", refers))
    assert got == sorted(want, key=repr)
    assert max(len(r["data"]) for r in table.collect()) < 2000
    parsed = [x for a in {r["archive"] for r in table.select("archive").distinct().collect()} for x in warc.parse_stream(warc.archive_stream(table, a))]
    assert len(parsed) == len(rows)
    for fields, payload in parsed:
        assert fields["warc-type"] == "revisit" or hashlib.sha1(payload).hexdigest() == fields["warc-payload-digest"].removeprefix("sha1:")
    broken = table.filter("chunk <> 2")
    with pytest.raises(Exception):
        warc.read_archives(broken).collect()
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a>x</a></li></ul></nav>
<!-- ad --><div class="ad">buy</div><article><h1>Head &amp; line</h1><p><b>One  <i>two</i><br>three.<br><p>Four&nbsp;five</p><div class="share-box">share</div></article><footer>&copy; foot</footer>"""


def text(page):
    return html.Page(page).text()


def test_main_text_of_a_page():
    assert text(PAGE) == "Head & line\nOne two three.\nFour five"
    assert text("") == "" and text("<script>only") == "" and text("<p>a<!-- open") == "a"
    assert text("plain <b>bold</b> text & 1 < 2") == "plain bold text & 1 < 2"
    assert text("<main><header><h1>T</h1></header><ul><li>a<li>b</ul><table><tr><td>1<td>2</table></main><p>out") == "T\na\nb\n1\n2"
    assert text('<div role="dialog">c</div><p hidden>h</p><p>t</p><section class="comments"><p>c</p></section><form><p>f</p></form>') == "t"
    assert text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert text('<p title=it\'s>a</p><p title="x > y">b</p>') == "a\nb"


def site(host, n, rng, article=True):
    """Pages of one host: menu, newsletter and notice recur, teasers rotate, prose and comments differ."""
    for i in range(n):
        own = [" ".join(rng.choice(["ka", "lo", "mi", "ter", "un", "vo"]) + str(rng.randint(0, 99)) for _ in range(rng.randint(20, 60))) for _ in range(3)]
        prose = "".join(f"<p>{x}</p>" for x in own)
        inner = f'<h1>Title {i}</h1>{prose}<div>Follow {host}</div><p>Join the {host} list today</p>'
        body = f"<article>{inner}</article>" if article else f"<div>{inner}</div>"
        page = f"<html><body><div>Menu of {host}</div><table><tr><td>Head {host}</table>{body}<div><p>Teaser {i % 3} of {host}</p></div><div class='comments'><p>Comment {i}</p></div></body></html>"
        yield f"https://{host.upper()}:80/{i}", page, "\n".join([f"Title {i}", *own])


@pytest.fixture(scope="module")
def sites(spark):
    rng = random.Random(8)
    rows = [(h, *r) for h, n, article in (("a.org", 40, True), ("b.org", 30, False), ("c.org", 25, True)) for r in site(h, n, rng, article)]
    rows = [(i, url, page, want) for i, (_, url, page, want) in enumerate(rows)]
    return rows, spark.createDataFrame([(i, u, h, "x", 1) for i, u, h, _ in rows], "page_id long, url string, html string, kept string, site int").repartition(4)


def test_templates_carry_the_result(sites):
    rows, df = sites
    got = {r["page_id"]: r["text"] for r in html.main_text(df).collect()}
    assert got == {i: want for i, _, _, want in rows}
    off = {r["page_id"]: r["text"] for r in html.main_text(df, least_pages=10**9).collect()}
    assert sum(off[i] != got[i] for i in got) == len(got)
    joined = html.main_text(df, broadcast_rows=0)
    assert joined.columns == ["page_id", "url", "kept", "site", "text", "n_chars"]
    assert {r["page_id"]: r["text"] for r in joined.collect()} == got


def test_counts_equal_brute_force(sites, spark):
    rows, df = sites
    keys, sizes = {}, {}
    for _, url, page, _ in rows + rows[:30]:
        host = url[8:].split(":")[0].lower()
        p = html.Page(page, host)
        sizes.setdefault(host, set()).add(p.context)
        for key, rule in p.seen.items():
            keys.setdefault((host, key), [set(), rule])[0].add(p.context)
    share = {html.ABSOLUTE: 0, html.SHARE: 0.2, html.PROSE_SHARE: 0.6}
    want = {k for (h, k), (c, rule) in keys.items() if len(c) >= 5 and len(c) >= share[rule] * len(sizes[h])}
    table = html.parsed(df.union(df.filter("page_id < 30")))
    assert {r["key"] for r in html.site_templates(table).collect()} == want and len(want) >= 12


def varying(host, n, rng):
    """Pages without article or lists whose menu, advert, notice and footer differ in all their words, and what is right."""
    word = lambda: rng.choice(["ka", "lo", "mi", "ter", "un", "vo"]) + str(rng.randint(0, 9999))
    for i in range(n):
        own = [" ".join(word() for _ in range(rng.randint(20, 60))) for _ in range(rng.randint(1, 5))]
        menu = "".join(f"<li><a href='/{k}'>{word()}</a></li>" for k in range(rng.randint(3, 8)))
        body = f"<div id='post-{i}'><h1>Title {i}</h1>{''.join(f'<p>{x}</p>' for x in own)}</div>"
        yield f"https://{host}/{i}", f"<html><body><div class='top'><ul>{menu}</ul></div><div class='promo'>{word()} {word()}</div>{body}<div class='low'><p>{word()}</p><p>{word()}</p></div></body></html>", "\n".join([f"Title {i}", *own])


@pytest.fixture(scope="module")
def structured(spark):
    rng = random.Random(21)
    rows = [x for h, n in (("one.org", 30), ("two.org", 8), *((f"h{k}.org", 1) for k in range(6))) for x in varying(h, n, rng)]
    rows = [(i, *r) for i, r in enumerate(rows)]
    return rows, spark.createDataFrame([(i, u, h) for i, u, h, _ in rows], "page_id long, url string, html string").repartition(4)


def test_shapes_carry_the_result_where_words_differ(structured):
    rows, df = structured
    got = {r["page_id"]: r["text"] for r in html.main_text(df, lists=False).collect()}
    assert got == {i: want for i, _, _, want in rows}  # also on hosts of one page, by the count over hosts
    off = {r["page_id"]: r["text"] for r in html.main_text(df, least_pages=10**9, lists=False).collect()}
    assert all(off[i] != got[i] for i in got)


def test_shape_counts_equal_brute_force(structured):
    rows, df = structured
    own, hosts, sizes = {}, {}, {}
    for _, url, page, _ in rows:
        host = url[8:].split("/")[0]
        p = html.Page(page, host, False)
        sizes.setdefault(host, set()).add(p.context)
        for key, (shape, held) in p.shapes.items():
            own.setdefault((host, shape, key), {})[p.context] = (held, p.letters)
    for (host, shape, _), pages in own.items():
        hosts.setdefault(shape, []).extend([(host, *x) for x in pages.values()])
    want = set()
    for (host, shape, key), pages in own.items():
        if sum(h for h, _ in pages.values()) > 0.2 * sum(n for _, n in pages.values()):
            continue
        everywhere = hosts[shape]
        common = len({h for h, _, _ in everywhere}) >= 5 and sum(h for _, h, _ in everywhere) <= 0.2 * sum(n for _, _, n in everywhere)
        if common or (len(pages) >= 5 and len(pages) >= 0.2 * len(sizes[host])):
            want.add(key)
    table = html.parsed(df.union(df), False)
    assert {r["key"] for r in html.shape_templates(table).collect()} == want and len(want) >= 20


def test_counts_alone_give_the_text_of_the_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    plain = pages.withColumn("html", F.regexp_replace("html", r"<(/?)(article|main)\b", "<$1div"))
    texts = lambda df: {r["page_id"]: r["text"] for r in df.collect()}
    want, got = texts(html.main_text(pages)), texts(html.main_text(plain, lists=False))
    assert sum(got[i] == want[i] for i in want) >= 0.9 * len(want)
    off = texts(html.main_text(plain, least_pages=10**9, lists=False))
    assert sum(off[i] != got[i] for i in want) >= 0.9 * len(want)


def test_copies_of_a_page_count_once(spark):
    article = "<article><h1>One</h1><p>Own words here</p><div>An aside of it</div></article>"
    rows = [(i, f"http://h/{i}", f"<div>menu {i}</div>{article}") for i in range(50)] + [(90 + i, f"http://h/x{i}", f"<article><p>Other words {i}</p></article>") for i in range(6)]
    got = {r["page_id"]: r["text"] for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[7] == "One\nOwn words here\nAn aside of it" and got[92] == "Other words 2"


def test_odd_pages(spark):
    rows = [(i, f"https://H.example/{i}", f"<div><p>Menu one two</p></div><div><p>Own text {i} is longer</p></div>", "t") for i in range(8)]
    rows += [(50 + i, f"https://h.example/a{i}", f"<article><p>Quoted passage</p><p>Own {i}</p><div>Read more here</div></article>", "t") for i in range(8)]
    rows += [(90, None, "<div>Menu one two</div>", "t"), (91, "http://other/", "<div><p>Menu one two</p></div>", "t"), (92, "x", None, "t"), (93, None, "", None), (None, "y", "<p>null id</p>", "t")]
    rows += [(3, "https://H.example/3", rows[3][2], "t"), (95, "http://long/", "<article>" + "<p>word &amp; word</p>" * 60_000 + "</article>", "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = html.main_text(df).collect()
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in out}
    assert len(out) == len(rows)
    assert got[3][0] == "Own text 3 is longer" and got[52][0] == "Quoted passage\nOwn 2" and got[90][0] == got[91][0] == "Menu one two" and got[92] == got[93] == ("", 0)
    assert got[None] == ("null id", 7) and got[95][0] == "\n".join(["word & word"] * 60_000)
    assert html.main_text(df.limit(0)).count() == 0


def exact(rows, every, k):
    ok = [(i, np.array(v, dtype=np.float64)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    ids, m = np.array([i for i, _ in ok]), np.array([v for _, v in ok])
    out = {}
    for i, v in ok:
        if i % every == 0:
            s = m @ v
            keep = ids != i
            order = np.lexsort((ids[keep], -s[keep]))[:k]
            out[i] = list(zip(ids[keep][order].tolist(), s[keep][order].tolist()))
    return out


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(1)
    same = rng.standard_normal(32).astype(np.float32).tolist()
    rows = [(i, rng.standard_normal(32).astype(np.float32).tolist()) for i in range(1500)] + [(5000 + i, same) for i in range(120)]
    rows += [(9000, None), (9020, [0.0] * 32), (9040, [float("nan")] * 32), (9060, [1.0, None] * 16), (9080, [float("inf")] + [0.0] * 31), (None, same)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int")
    got = {}
    for r in ann.search(df, part_rows=100).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = exact(rows, 20, 20)
    assert got.keys() == want.keys()
    hit = 0
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 21)) and len({v for _, v, _ in found}) == 20
        hit += len({v for _, v, _ in found} & {v for v, _ in want[q]})
    assert hit / (20 * len(want)) >= 0.9
    assert [v for _, v, _ in got[5000]] == [v for v, _ in want[5000]]
    truth = {i: np.array(v, dtype=np.float64) for i, v in rows[:1620]}
    assert all(abs(s - truth[q] @ truth[v]) < 1e-9 for q, found in got.items() for _, v, s in found)


def recall(spark, rows, **limits):
    """Share of the exact 20 nearest found, over all queries."""
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = {}
    for r in ann.search(df, **limits).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = exact(rows, 20, 20)
    assert got.keys() == want.keys()
    return sum(len(got[q] & {v for v, _ in w}) for q, w in want.items()) / sum(len(w) for w in want.values())


def test_recall_on_the_test_vectors(spark):
    path = "/root/testdata/sf0.1/embeddings.parquet"
    if not os.path.exists(path):
        pytest.skip("no test data")
    got = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in spark.read.parquet(path).collect()]
    assert recall(spark, got) >= 0.9


def test_recall_on_clusters(spark):
    rng = np.random.default_rng(2)
    heart = rng.standard_normal((60, 48)) * 3
    rows = [(i, (heart[i % 60] + rng.standard_normal(48)).astype(np.float32).tolist()) for i in range(3600)]
    assert recall(spark, rows) >= 0.9
    assert recall(spark, rows, part_rows=20, block_queries=50) >= 0.9
    sample = np.array([v for _, v in rows])
    centres = ann.kmeans(sample, 60)
    assert ann.probes_needed(sample, centres, 20, 0.96) <= 20


def test_candidates_are_abandoned():
    """The tests decide the work: most candidates go before the last block, and how many depends on the confidence."""
    rng = np.random.default_rng(3)
    rows = rng.standard_normal((4000, 64))
    queries = rng.standard_normal((200, 64))
    ids, turn = np.arange(4000), ann.rotation(64)
    score = queries @ rows.T
    floor = -np.sort(-score, axis=1)[:, 40]  # what a first pass over a part of the vectors gives
    work = {}
    for confidence in (1.0, 2.0, 4.0, np.inf):
        part = ann.Part(rows, ids, 20, turn, confidence)
        qi, found, exact_score = part.scan(queries, np.full(200, -1), floor)
        truth = [set(np.argsort(-score[i])[:20].tolist()) for i in range(200)]
        hit = sum(f in truth[i] for i, f in zip(qi, found)) / 4000
        assert np.allclose(exact_score, score[qi, found]) and part.pairs == 800_000
        work[confidence] = (part.early / part.pairs, part.dims / part.pairs, hit)
    assert work[2.0][0] > 0.75 and work[2.0][1] < 45 and work[2.0][2] > 0.95
    assert work[1.0][1] < work[2.0][1] < work[4.0][1] < work[np.inf][1] == 64
    assert work[np.inf][2] == 1 and work[np.inf][0] == 0


def test_repeated_query_ids(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [2.0, 1.0]), (2, [1.0, 3.0]), (2, [1.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.search(df).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 2, 3.0), (0, 2, 2, 3.0), (0, 3, 1, 1.0)]


def test_few_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (20, [0.0, 1.0]), (3, [1.0])], "vec_id long, embedding array<double>")
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in ann.search(df).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 20), (20, 1, 1), (20, 2, 0)]
    assert ann.search(df.limit(0)).count() == 0


def test_archive_parsed_in_small_pieces(spark):
    rows = [(1, "http://a", "x" * 5000 + "\r\n\r\n" + "y" * 3000), (2, "u", ""), (3, "v", "small é"), (4, "w", "x" * 5000 + "\r\n\r\n" + "y" * 3000)]
    table = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), chunk_bytes=700)
    stream = b"".join(b for a in sorted(r["archive"] for r in table.select("archive").distinct().collect()) for b in warc.archive_stream(table, a))
    want = [(f["warc-type"], hashlib.sha1(p).hexdigest()) for f, p in warc.parse_stream([stream])]
    assert len(want) == 4
    for size in (1, 7, 64, 1000):
        pieces = [stream[i : i + size] for i in range(0, len(stream), size)]
        assert [(f["warc-type"], hashlib.sha1(p).hexdigest()) for f, p in warc.parse_stream(pieces)] == want
    most = max(len(p) for _, p, _ in warc.parse_chunks(stream[i : i + 64] for i in range(0, len(stream), 64)))
    assert most <= 1024
    with pytest.raises(ValueError):
        list(warc.parse_stream([stream[:-10]]))
