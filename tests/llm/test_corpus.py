"""HTML extraction, importance resampling and the Merkle manifest."""

import hashlib
import html
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from stratalake.llm import common, html_wrappers, importance, merkle, queries

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SMALL), reason="tables not present")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Numbering


def test_numbered_places_rows_of_a_hot_group(spark):
    rows = [("hot" if i % 3 else None, (i * 7919) % 50, i) for i in range(2000)]
    df = common.stored(spark.createDataFrame(rows, "g string, k int, __size int").repartition(6), "numbered")
    found = common.numbered(df.withColumnRenamed("__size", "i"), ["k"], ["g"]).collect()
    assert len(found) == 2000
    for group in ("hot", None):
        mine = sorted((r for r in found if r["g"] == group), key=lambda r: r["__place"])
        assert [r["__place"] for r in mine] == list(range(len(mine)))
        assert [r["k"] for r in mine] == sorted(r["k"] for r in mine)
        assert {r["__size"] for r in mine} == {len(mine)}


# HTML extraction

PAGES = {
    None: "",
    "": "",
    "plain &lt; text": "plain < text",
    "<article><h1>T</h1><p>x<p>y<ul><li>1<li>2</ul></article>": "T\nx\ny\n1\n2",
    "<article><p>a < b and <3 c</p><p>x&nbsp;\n y<br>z</p><!-- <p>no</p> --><script>if(a<b){'</p>'}</script><p>q": "a < b and <3 c\nx y z\nq",
    "<article><header class='entry-header'><h1>H</h1>by me</header><p>p</p><footer>f</footer></article>": "H\np",
    "<article>one<p>two</p>three</article><aside>x</aside><article class='comment'>no</article>": "one\ntwo\nthree",
    "<article><p>in <span class='ad'>buy <span>now</span></span> one <b>li</b>ne</p><div class='postComments'>c</div></article>": "in one line",
    "<article><p>a</p><form>f<button>b</button></form><div hidden>h</div><nav>n</nav><table><tr><td>1<td>2</table></article>": "a\n1\n2",
    "<body class='has-sidebar'><div id='header'>H</div><div class='content-with-sidebar'><h1>A</h1><div class='cookie-notice'>n</div>"
    "<p>t</p></div><div id='sidebar'>S</div>": "A\nt",
    "<main><p>m</p><section id='comments'><p>c</p></section></main><p>outside</p>": "m",
    "<html><body><ul><li><a href=x>menu</a></li></ul><h1>Head</h1><div><p>long prose here</p><p>and more</p></div></body>": "Head\nlong prose here\nand more",
    "<article><p a=\"b>c\">t &eacute;&#8212;&#x41;</p": "t é—A",
    "<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>after</article><p>out": "deep\nafter",
}


def test_parts_of_pages(spark):
    rows = [(i, f"http://h{i}.org/", page, "s", "l", "w") for i, page in enumerate(PAGES)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, site string, layout string, wrapper string")
    found = {r["page_id"]: r["text"] for r in html_wrappers.main_texts(pages).collect()}
    assert found == dict(enumerate(PAGES.values()))
    empty = html_wrappers.main_texts(pages.where("page_id < 0"))
    assert empty.collect() == [] and empty.columns == ["page_id", "url", "text"]


def test_wrappers_generalise_and_match_in_any_order():
    def own(page):
        return html_wrappers.wrapper_of(html_wrappers.parse(page))

    pages = ["<h2>a</h2><p>x</p>", "<h2>a</h2><p>y</p><p>z</p><ul><li>1</ul>", "<h2>a</h2><ul><li>2<li>3</ul><p>w</p>"]
    first = html_wrappers.align(own(pages[0]), own(pages[1]))
    assert re.sub("'[0-9a-f]+'", "'c'", html_wrappers.written(first)) == "<h2>'c'</>(<p>#</>)+(<ul><li>'c'</></>)?"
    whole = html_wrappers.align(first, own(pages[2]))
    assert re.sub("'[0-9a-f]+'", "'c'", html_wrappers.written(whole)) == "<h2>'c'</>((<ul>(<li>#</>)+</>)?(<p>#</>)?)+"

    def slots(content, way=()):
        for _, items in content:
            for label, _, inner in items:
                if label == "#":
                    yield way, tuple(inner[:3])
                else:
                    yield from slots(inner, (*way, label))

    rng = random.Random(3)
    many = []
    for _ in range(60):
        tags = [rng.choice(["<h2>", "<p>", "<ul><li>", "<blockquote>"]) for _ in range(rng.randrange(9))]
        many.append("<article>" + "".join(f"{tag}{rng.choice('abc')}" for tag in tags) + "</article>")
    results = []
    for order in (many, many[::-1]):
        content = own(order[0])
        for page in order[1:]:
            content = html_wrappers.align(content, own(page))
        found = list(slots(content))
        assert len(found) == len({way for way, _ in found})  # each way once, however many pages
        results.append(dict(found))
    assert results[0] == results[1]
    assert sum(n for n, _, _ in results[0].values()) == sum(len(re.findall("[abc]<", page)) for page in many)


def test_a_hot_host_is_aligned_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(html_wrappers, "FAN_IN", 2)
    body = "<body><div>Menu of the site</div><section><p>{}</p></section><section>{}</section></body>"
    rows = [(i, "http://hot.org/" if i % 3 else None, body.format("text " * (i + 5), "<p>x</p>" * (i % 4))) for i in range(90)]
    pages = spark.createDataFrame(rows * 2, "page_id long, url string, html string").repartition(12)
    found = html_wrappers.wrappers(pages).collect()
    assert sorted((r["site"], r["layout"], r["pages"]) for r in found) == [("", "", 60), ("hot.org", "", 120)]
    texts = html_wrappers.main_texts(pages).collect()
    assert len(texts) == 180
    for row in texts:
        i = row["page_id"]
        assert row["text"].split("\n")[0] == ("text " * (i + 5)).strip() and "Menu" not in row["text"]


@needs_tables
def test_extraction_of_the_tables_equals_plain_version(spark):
    for row in queries.op11_html_extraction(spark, MIDDLE).join(spark.read.parquet(f"{MIDDLE}/pages.parquet"), "page_id").collect():
        article = re.search("<article>(.*)</article>", row["html"], re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert row["text"] == "\n".join(b for b in blocks if b) and row["n_chars"] == len(row["text"])


# Importance resampling

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, weight string, score string, __row string"


def plain_resample(docs, target, percent, least):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans(importance.UPPER, importance.LOWER)

    def buckets(text):
        return [zlib.crc32(w.encode()) % importance.BUCKETS for w in word.findall((text or "").translate(lower))]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(buckets(text))
    for text in target:
        t.update(buckets(text))
    size, n = sum(s.values()) + importance.BUCKETS, sum(t.values()) + importance.BUCKETS
    rows = []
    for number, text in docs:
        found = buckets(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * size / ((s[b] + 1) * n))) for b in found)
        h = int(sha(f"2024:{'' if number is None else number}")[:8], 16)
        rows.append((number, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    return rows, able[: len(able) * percent // 100]


def test_resampling_equals_plain_version(spark):
    rng = random.Random(5)
    words = ["Straße", "a1", "ÉTÉ", "x", "Zwei", "drei", "日本", "Öl", "co"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(40))) + rng.choice(["", ".", "\x00x-y"])) for i in range(300)]
    docs += [(300, None), (301, ""), (302, "x " * 30_000), (None, "a1 " * 25), (7, docs[7][1]), (7, docs[7][1])] + [(9, "a1 x " * 20)] * 50
    target = ["a1 Zwei", None, "", "日本 a1 öl"]
    rows, drawn = plain_resample(docs, target, 10, 20)
    df = spark.createDataFrame([(i, t, None, None, None, "w", "s", "r") for i, t in docs], DOCUMENTS).repartition(5)
    found = importance.resample(df, spark.createDataFrame([(t,) for t in target], "text string")).collect()
    assert sorted((tuple(r)[:4] for r in found), key=repr) == sorted(rows, key=repr)
    ranked = sorted((r for r in found if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [tuple(r)[:4] for r in ranked] == drawn
    nothing = importance.resample(df.limit(0), spark.createDataFrame([], "text string"))
    assert nothing.collect() == [] and nothing.columns == ["doc_id", "n_features", "weight", "score", "rank"]


def test_quickselect_finds_every_rank(spark):
    values = [(v, i) for i, v in enumerate([None, None, -3, 5, 5, 5, 0, 2**62, -(2**62)] + list(range(40)))]
    rows = common.stored(spark.createDataFrame(values, "v long, i long"), "keys")
    order = sorted(values, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for k in (0, 1, 2, 3, 7, 24, 48, 49, 60):
        found = importance.first_keys(rows, k, ["v", "i"], pivots=3).collect()
        assert sorted(map(tuple, found), key=repr) == sorted(order[:k], key=repr)


# Merkle manifest


def plain_tree(nodes):
    """The root, and for each node its siblings level by level."""
    ways, groups = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        parents, above = [], []
        for start in range(0, len(nodes), 16):
            run = nodes[start : start + 16]
            for place in range(len(run)):
                for i in groups[start + place]:
                    ways[i].append(("".join(run[:place]), "".join(run[place + 1 :])))
            parents.append(sha("".join(run)))
            above.append([i for members in groups[start : start + 16] for i in members])
        nodes, groups = parents, above
    return nodes[0], ways


def plain_manifest(rows):
    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append((row[0] is not None, row[0] or 0, leaf(row), row))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([n[2] for n in sorted(groups[g], key=lambda n: n[:3])]) for g in order}
    root, ways = plain_tree([trees[g][0] for g in order])
    found = []
    for g, way in zip(order, ways):
        for node, own in zip(sorted(groups[g], key=lambda n: n[:3]), trees[g][1]):
            found.append((node[0] and node[1] if node[0] else None, g, node[2], trees[g][0], root, tuple(own + way)))
    return found


@pytest.mark.parametrize("sources", [1, 2, 40])
def test_manifest_equals_plain_version(spark, sources):
    rng = random.Random(sources)
    names = [None, "", "é", "zz", "Z", "-", "="] + [f"s{i}" for i in range(33)]
    rows = []
    for i in range(700):
        source = names[0] if sources == 1 else names[min(int(rng.expovariate(0.6)), sources - 1)]
        rows.append((i if i % 50 else None, source, rng.choice([None, "en"]), rng.choice([None, i]), rng.choice([None, "", "Ünï" * i])))
    rows += [rows[7]] * 40 + [(1000, names[3 % sources], "x", 5, "t" * 300_000)]
    rows += [(2000 + i, name, None, None, None) for i, name in enumerate(names[:sources])]
    extra = [(*row, "a", "b", "c") for row in rows]
    columns = "doc_id long, source string, lang string, n_chars long, text string, tree string, digest string, path string"
    found = merkle.proofs(spark.createDataFrame(extra, columns).repartition(7)).collect()
    got = [(*tuple(r)[:5], tuple((s["left"], s["right"]) for s in r["path"])) for r in found]
    assert sorted(got, key=repr) == sorted(plain_manifest(rows), key=repr)


def test_manifest_of_few_rows(spark):
    columns = "doc_id long, source string, lang string, n_chars long, text string"
    assert merkle.proofs(spark.createDataFrame([], columns)).collect() == []
    (one,) = merkle.proofs(spark.createDataFrame([(1, None, "en", 2, "Aé")], columns)).collect()
    assert one["leaf"] == one["subroot"] == one["root"] == sha("1:1-2:en1:23:Aé") and one["path"] == []


@needs_tables
def test_tampered_texts_fail_and_others_hold(spark):
    found = queries.op13_merkle_manifest(spark, SMALL).join(spark.read.parquet(f"{SMALL}/documents.parquet"), "doc_id").collect()
    for row in found:
        lowered = (row["text"] or "").translate(str.maketrans(importance.UPPER, importance.LOWER))
        changed = zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0 and lowered != (row["text"] or "")
        assert row["verified"] == (not changed) == (row["folded_root"] == row["root"])
    assert len({row["root"] for row in found}) == 1 and any(not row["verified"] for row in found)
