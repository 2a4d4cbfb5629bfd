"""Column builders against expected values and the standard library."""

import hashlib
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from tablewright.functions import text as T
from tablewright.functions import urls as U


def one(spark, value, build, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(build(F.col("v")).alias("r")).first()["r"]


def many(spark, values, build, kind="string"):
    d = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["r"] for r in d.select("i", build(F.col("v")).alias("r")).orderBy("i").collect()]


@pytest.mark.parametrize(
    ("path", "family"),
    [
        ("/football/l-NFL", "/football/l-{id}"),
        ("/football/roster/t-CHI/y-1924", "/football/roster/t-{id}/y-{year}"),
        ("/players/r/rice02100.html", "/players/r/{id}.html"),
        ("/coaches/beli01900.html", "/coaches/{id}.html"),
        ("/1963nfl.html", "/{year}nfl.html"),
        ("/a/12/b?x=1#y", "/a/{n}/b"),
        ("/x/some-long-slug/", "/x/{slug}/"),
        ("", "/"),
    ],
)
def test_url_pattern(spark, path, family):
    assert one(spark, path, U.url_pattern) == family


def test_url_pattern_like_the_rules_in_python(spark):
    rnd = random.Random(1)
    paths = ["".join(rnd.choice("/ab-1290.p{htmlplayers") for _ in range(rnd.randint(0, 30))) for _ in range(1500)]

    def plain(p):
        p = re.sub("[#?].*", "", p)
        for rule, to in U.FAMILY_RULES:
            p = re.sub(rule, to.replace("$1", r"\1"), p)
        return p or "/"

    assert many(spark, paths, U.url_pattern) == [plain(p) for p in paths]


def test_shards_like_hashlib(spark):
    keys = [f"key {i} é" for i in range(200)] + [""]
    for n in (1, 3, 7, 60):
        assert many(spark, keys, lambda c, n=n: T.shard_of(c, n)) == [int(hashlib.sha256(k.encode()).hexdigest(), 16) % n for k in keys]
        assert many(spark, keys, lambda c, n=n: T.shard_of(c, n, "sha1")) == [int(hashlib.sha1(k.encode()).hexdigest(), 16) % n for k in keys]
    with pytest.raises(ValueError, match="positive"):
        T.shard_of(F.lit("x"), 0)


def test_headers(spark):
    assert many(spark, ["Pos.", " Jersey # ", "", "É--x", "a b"], T.normalize_header) == ["pos", "jersey", "", "x", "a_b"]
    rows = spark.createDataFrame([(0, i, h) for i, h in enumerate(["date", "", "comp", "comp", "", "comp_2"])], "t int, pos int, label string")
    got = T.unique_keys(rows, ["t"], "label", "pos").orderBy("pos").collect()
    assert [r["key"] for r in got][:5] == ["date", "col_1", "comp", "comp_2", "col_4"] and len({r["key"] for r in got}) == 6
    assert sum(r["blank"] for r in got) == 2 and sum(r["duplicate"] for r in got) == 1


def test_squeeze_and_decode(spark):
    assert many(spark, [" a  b\n c ", "\x1c", "x"], T.squeeze) == ["a b c", "", "x"]
    for raw in (b"caf\xc3\xa9", b"a\xffb", b"\xe2\x82", b"\xf0\x9f\x98x", b""):
        assert one(spark, raw, T.page_text, "binary") == raw.decode("utf-8", "replace")


def test_fingerprint_is_of_sorted_names(spark):
    want = hashlib.sha256(json.dumps(["a", "b"], separators=(",", ":")).encode()).hexdigest()
    assert many(spark, [["b", "a", "b"], ["a", "b"]], T.schema_fingerprint, "array<string>") == [want, want]


@pytest.mark.parametrize(
    ("n", "columns", "ids", "verdict"),
    [
        (0, ["player"], ["player"], "unusable"),
        (1, ["player", "team", "season", "x"], ["player", "team", "season"], "canonical_candidate"),
        (1, ["player", "season"], ["player", "season"], "identity_only"),
        (1, ["story"], [], "context_only"),
        (1, ["team", "pts"], ["team"], "corroborating_witness"),
        (1, ["pts"], [], "unusable"),
        (1, ["pts"], ["team"], "unusable"),
    ],
)
def test_verdicts(spark, n, columns, ids, verdict):
    d = spark.createDataFrame([(n, columns, ids)], "n int, c array<string>, i array<string>")
    assert d.select(T.classify_surface(F.col("n"), F.col("c"), F.col("i")).alias("v")).first()["v"] == verdict


def test_renamed_identifiers_keep_their_verdict(spark):
    cols = [["name", "year", "team"]]
    ids = many(spark, cols, T.census_identifiers, "array<string>")[0]
    assert set(ids) == {"player", "season", "team"}
    v = lambda strict: many(spark, cols, lambda c: T.classify_surface(F.lit(1), T.census_columns(c, strict), T.census_identifiers(c)), "array<string>")[0]
    assert v(False) == "canonical_candidate" and v(True) == "unusable"


def test_status_and_stability(spark):
    assert many(spark, [200, 404, 429, 503, 403, 401, 302], T.status_class, "int") == ["ok", "absent", "throttled", "retryable", "blocked", "blocked", "error"]
    assert many(spark, [1.0, 0.9, 0.899, 0.5, 0.1], T.stability, "double") == ["structural", "structural", "common", "common", "variant"]


def test_dataset_names(spark):
    got = many(spark, ["/players/{letter}/{id}.html", "/drafts/{year}nfldraft.html", "/football/stats/p-{id}", "/{x}"], U.dataset_name)
    assert got == ["players", "drafts", "football_stats", "family"]


def test_allow_list(spark):
    urls = ["https://a.b/x/y", "http://a.b:80/x/y", "ftp://a.b/x", "https://A.b/x", "https://a.b/z", "nonsense", "https://a.b/x y%zz"]
    assert many(spark, urls, lambda c: U.url_allowed(c, ["a.b"], ["/x"])) == [True, False, False, False, False, False, True]


def test_links(spark):
    html = "<A class=x HREF='/a'>1</a><a href=\"b?x#y\">2</a><a href=c>3</a><a href='mailto:x'>4</a>"
    assert one(spark, html, U.page_links) == ["/a", "b?x#y", "mailto:x"]
    assert many(spark, ["/a", "#x", "tel:1", "javascript:x", "x"], U.followable) == [True, False, False, False, True]
    xml = "<?xml?><urlset><loc> b </loc><LOC>a</LOC><loc>b</loc></urlset>"
    assert one(spark, xml, U.sitemap_links) == ["a", "b"] and one(spark, xml, U.is_sitemap)


def test_resolve_like_the_standard_library(spark):
    from urllib.parse import urljoin

    base = "https://h.x/a/b.html?q#f"
    hrefs = ["/r", "c", "../d", "//o/p", "https://z/y", "?n", "#m", "/a/../b", "./", "", "http://z/a/../b", "/x;y?z", "https://z", "/r?", "/r#"]
    got = spark.createDataFrame([(i, base, h) for i, h in enumerate(hrefs)], "i int, b string, h string").select("i", U.resolve(F.col("b"), F.col("h")).alias("r")).orderBy("i").collect()
    assert [r["r"] for r in got] == [urljoin(base, h) for h in hrefs]


def test_native_ids(spark):
    assert many(spark, ["/football/p-x1", "/o'neal01.html", "/a.html", None], T.has_native_id) == [True, True, False, False]
    assert many(spark, [["player_name", "yds", "date"]], T.detected_id_columns, "array<string>") == [["player_name", "date"]]


def test_maps(spark):
    d = spark.createDataFrame([({"fum": "1", "lost": "2", "fumbles": "9"},)], "m map<string,string>")
    got = d.select(T.fumble_alias(F.lit("logs"), F.col("m")).alias("a"), T.fumble_alias(F.lit("career"), F.col("m")).alias("b")).first()
    assert got["a"] == {"fum": "1", "lost": "2", "fumbles": "1", "fumbles_lost": "2"} and got["b"]["fumbles"] == "9"
