"""URL names, strip and slug: goldens plus a plain-Python statement of each rule compared
with the Spark expression on generated Unicode strings."""

import random
import re
from urllib.parse import urlparse

import pytest

from sitecorpus.functions.text import collapse_spaces, py_strip, slug
from sitecorpus.functions.urls import url_domain, url_error, url_filename

URL_GOLDENS = [
    ("https://www.ex.com/", "ex.com", "ex.com_index.md"),
    ("https://ex.com/a/b/?q=1#f", "ex.com", "ex.com_a_b.md"),
    ("https://ex.com/a_b", "ex.com", "ex.com_a_b.md"),
    ("https://www.awww.ex.com/a", "aex.com", "aex.com_a.md"),
    ("http://u:p@ex.com:80/x;q=1/y;v?z", "u:p@ex.com:80", "u:p@ex.com:80_x;q=1_y.md"),
    ("http://ex.com/x y", "ex.com", "ex.com_x y.md"),
    ("http://ex.com//a//b", "ex.com", "ex.com_a__b.md"),
]


def test_url_goldens(spark):
    df = spark.createDataFrame([(u,) for u, _, _ in URL_GOLDENS], "url string")
    got = df.select("url", url_domain("url").alias("d"), url_filename("url").alias("f")).collect()
    assert [(r.d, r.f) for r in got] == [(d, f) for _, d, f in URL_GOLDENS]


def test_bad_url(spark):
    r = spark.createDataFrame([("http://[bad/x",)], "url string").select(url_error("url")).first()
    assert r[0] == "bad_url"


def _py_filename(url):
    p = urlparse(url)
    path = p.path.strip("/").replace("/", "_") or "index"
    return f"{p.netloc.replace('www.', '')}_{path}.md"


def _py_slug(title):
    s = re.sub(r"[^\w\s-]", "", title).strip()
    s = re.sub(r"[-\s]+", "-", s).lower()
    return s[:50] or "untitled"


def _random_strings(n, seed=7):
    rng = random.Random(seed)
    pool = ("abcXYZ019 _-.\t\n  　 \x1c\x85é́ß漢字äöü!?&\"'"
            "​ ²½٣")
    return ["".join(rng.choice(pool) for _ in range(rng.randint(0, 24))) for _ in range(n)]


def test_strip_collapse_slug_match_python(spark):
    vals = _random_strings(400)
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = df.select(py_strip("s").alias("a"), collapse_spaces("s").alias("b"),
                    slug("s").alias("c")).collect()
    for v, r in zip(vals, got):
        assert r.a == v.strip()
        assert r.b == " ".join(v.split())
        assert r.c == _py_slug(v), repr(v)


def test_filename_matches_python(spark):
    rng = random.Random(3)
    parts = ["a", "b c", "x;y", "", "%20", "é", "_", "..", "q?z=1", "#f"]
    urls = [f"{rng.choice(['http', 'https'])}://{rng.choice(['www.ex.com', 'ex.com:8080', 'a.www.b'])}/"
            + "/".join(rng.choice(parts) for _ in range(rng.randint(0, 4))) for _ in range(200)]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = df.select(url_filename("url").alias("f")).collect()
    for u, r in zip(urls, got):
        assert r.f == _py_filename(u), u


@pytest.mark.parametrize("title,folder", [
    ("Page non trouvée – 404", "page-non-trouvée-404"), ("!!!", "untitled"), ("", "untitled"),
    ("A  -  B", "a-b"), ("a b", "a-b"), ("x" * 60, "x" * 50), ("-lead", "-lead")])
def test_slug_goldens(spark, title, folder):
    assert spark.createDataFrame([(title,)], "t string").select(slug("t")).first()[0] == folder


def test_read_sitemaps_from_files(spark, tmp_path):
    from sitecorpus.sources.sitemaps import SITEMAP_NS, read_sitemaps, expand_seeds
    ns = f'<urlset xmlns="{SITEMAP_NS}">'
    files = {
        "a.xml": ns + "<url><loc> http://h/1 </loc></url><url><loc>http://h/1</loc></url>"
                 "<url><loc/></url><url><loc> </loc></url><url><loc>x</loc><loc>y</loc></url></urlset>",
        "plain.xml": "<urlset><url><loc>http://h/2</loc></url></urlset>",
        "broken.xml": ns + "<url><loc>http://h/3</loc>",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    got = read_sitemaps(spark, str(tmp_path)).collect()
    by_file = {}
    for r in got:
        by_file.setdefault(r.file.rsplit("/", 1)[-1], []).append((r.pos, r.url))
    assert sorted(by_file["a.xml"]) == [(1, "http://h/1"), (2, "http://h/1"), (3, ""), (4, "x")]
    assert "plain.xml" not in by_file and "broken.xml" not in by_file
    seeds = spark.createDataFrame([("http://h/a.xml",), ("http://h/a.XML",), ("http://h/a.xml?x=1",)],
                                  "seed string")
    out = expand_seeds(seeds, spark.createDataFrame([], "file string, pos long, url string"))
    assert sorted(r.url for r in out.collect()) == ["http://h/a.XML", "http://h/a.xml?x=1"]
