"""Language identification, main text and near duplicates: accuracy, brute force, edge cases."""

import itertools
import random
from math import log2

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import language, maintext, near

# --- language ---------------------------------------------------------------------------------------


def brute_length(text: bytes, samples: list[bytes]) -> float:
    """PPM code length by walking contexts, longest first."""
    seen: dict[bytes, dict[int, int]] = {}
    for s in samples:
        s = language.PAD + s
        for i in range(3, len(s)):
            for k in range(4):
                c = seen.setdefault(s[i - k : i], {})
                c[s[i]] = c.get(s[i], 0) + 1
    total, t = 0.0, language.PAD + text
    for i in range(3, len(t)):
        for k in (3, 2, 1, 0):
            c = seen.get(t[i - k : i])
            if not c:
                continue
            n, d = sum(c.values()), len(c)
            if t[i] in c:
                total -= log2(c[t[i]] / (n + d))
                break
            total -= log2(d / (n + d))
        else:
            total += 8
    return total


def test_code_lengths_are_exact():
    samples = {"x": [b"the cat sat on the mat", b"that hat"], "y": [b"le chat est la", b""]}
    m = language.train(samples)
    texts = [b"the chat", b"", b"zzz\xff", b"that cat is on la mat " * 40]
    got = m.lengths(texts)
    for (i, t), (k, g) in itertools.product(enumerate(texts), enumerate(m.languages)):
        assert got[i, k] == pytest.approx(brute_length(t, samples[g]), abs=1e-3 * (1 + len(t)))


def test_code_lengths_of_many_bytes_and_contexts():
    """All 256 bytes, and far more contexts than any dense table of common ones would keep."""
    rnd = random.Random(6)
    samples = {"x": [rnd.randbytes(30_000)], "y": [bytes(range(256)) * 3 + rnd.randbytes(30_000)], "z": ["жук и лев 狮子 สิงโต".encode() * 5]}
    m = language.train(samples)
    assert len(m.three) > 55_000
    texts = [rnd.randbytes(400), samples["x"][0][:300] + b"\x00\xff", "лев жук 子狮 โตสิง".encode()]
    got = m.lengths(texts)
    for (i, t), (k, g) in itertools.product(enumerate(texts), enumerate(m.languages)):
        assert got[i, k] == pytest.approx(brute_length(t, samples[g]), abs=1e-3 * (1 + len(t)))
    with pytest.raises(ValueError, match="samples"):
        language.train(samples, max_model_bytes=1000)


def test_long_texts_are_scored_whole():
    m = language.train({"x": [b"abcab"], "y": [b"bca"]})
    t = bytes(random.Random(2).choices(b"abcd", k=2 * language.BLOCK + 17))
    a, b = m.lengths([t])[0], sum(m.lengths([t[i : i + 1000]])[0] for i in range(0, len(t), 1000))
    assert np.abs(a - b).max() < 0.02 * a.max()


def test_languages_of_documents(spark):
    rnd = random.Random(1)
    words = {"en": "the cat and dog with that house running over there".split(), "fr": "le chat et chien avec que maison où déjà très".split(), None: ["zzz"]}
    rows = [(i, " ".join(rnd.choices(words[g], k=12)), g, "s") for i in range(300) for g in [rnd.choice(["en", "fr", None])]]
    rows += [(1000, None, "en", "s"), (1001, "", "en", "s"), (1002, "123 !?", "en", "s"), (None, "the cat", "en", "s"), (1003, "the cat " * 60_000, "en", "s"), (1003, "le chat", "fr", "s")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, held_out string")
    got = language.identify(d).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == g for i, _, g, _ in rows[:300] if g)
    assert all((by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0) for i in (1000, 1001, 1002))
    assert all(0 <= r["score"] <= 1 for r in got) and by[None]["lang_pred"] == "en"
    import zlib

    assert all(by[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in range(300))
    assert {r["lang_pred"] for r in language.identify(d.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.identify(d.filter("false")).count() == 0


# --- main text --------------------------------------------------------------------------------------

LONG = "This paragraph is long enough, with commas and words, to count as content on any page."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("<article><p>One &amp; two<br>three <b>fo</b>ur<aside>x y z</aside><form><p>mail please now</form><script>if(a<b){}</script><p>end</article><footer>f</footer>", "One & two three four end"),
        (f"<div class='menu'>a b</div><div><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div><div id=comments><p>{LONG}</p></div>", f"{LONG} Short. {LONG}"),
        (f"<nav><ul><li><a href=/>Home</a><li><a href=/x>{LONG}</a></ul></nav><main><h1>Title</h1><p>{LONG}</p><div class='ad-banner'>{LONG}</div></main>", f"Title {LONG}"),
        (f"<article><header><h1>T</h1></header><p>{LONG}</p><section class=related><p>{LONG}</p></section></article><div hidden><p>{LONG}</p></div>", f"T {LONG}"),
        (f"<article><p>{LONG} &lt;b&gt; &#233;&eacute; &am</p></article", f"{LONG} <b> éé &am"),
        (f"<!-- <p>no --><article><P CLASS=x>{LONG}<p>  a\n\t b  <!-- open", f"{LONG} a b"),
        (f"<article><table><tr><td>one<td>two</table><p>{LONG}</article>", f"one two {LONG}"),
        (f"<header><p>{LONG}</p></header><article><p>{LONG}</article><div role=dialog><p>{LONG}</div><button>Buy</button>", LONG),
        ("<<<>>> <a href=\"x>y", "<<<>>>"),
        # Wrappers named after layout, or after parts.
        (f"<div id='content' class='has-sidebar'><article><p>{LONG}</p></article></div><div class='sidebar'><p>{LONG}</p></div>", LONG),
        (f"<div class='page no-sidebar'><main><p>{LONG}</p></main></div>", LONG),
        (f"<div class='col-text form-group'><article><p>{LONG}</p></article></div>", LONG),
        (f"<article><div class='notice-free text'><p>{LONG}</p></div></article>", LONG),
        (f"<form id=aspnetForm><div class=menu>a b</div><article><p>{LONG}</p><form><p>{LONG}</form></article></form>", LONG),
        (f"<article><p>{LONG}</p><div class='comment-body'><p>{LONG}</p></div><div class='post-footer'>By a person.</div></article>", LONG),
        (f"<section id=comments><article><p>{LONG}</p></article></section><article><p>{LONG}</p></article>", LONG),
        # Foreign and unclosed elements.
        (f"<article><svg viewBox='0 0 1 1'/><p>{LONG}</p><math/><object data=x><p>{LONG}</article>", f"{LONG} {LONG}"),
        (f"<article><p>{LONG}</p><script>var x = '<p>no'", LONG),
    ],
)
def test_main_text(page, text):
    got = maintext.extract(page)[0]
    assert got == text or (page.startswith("<<<") and got in ("", text))


def generated_page(rnd):
    """A page around a known article, and its text."""
    word = lambda: "".join(rnd.choices("abcdefghijklmnoprstuvwz", k=rnd.randint(2, 9)))
    sentence = lambda n: " ".join(word() for _ in range(n)).capitalize() + rnd.choice(".!?")
    blocks, body = [], []
    for _ in range(rnd.randint(1, 12)):
        text = " ".join(sentence(rnd.randint(3, 25)) for _ in range(rnd.randint(1, 5)))
        kind = rnd.choice(["p", "p", "p", "h2", "li", "blockquote", "br", "entity"])
        if kind == "br":
            first, second = text, sentence(8)
            blocks += [first, second]
            body.append(f"<p>{first}<br>\n {second}</p>")
            continue
        blocks.append(text + (" <é> & more." if kind == "entity" else ""))
        inner = text.replace(" ", rnd.choice([" ", "\n\t", "  "]), 1).replace(text.split()[0], f"<b>{text.split()[0]}</b>", 1)
        body.append({"li": f"<ul><li>{inner}</ul>", "entity": f"<p>{inner} &lt;&eacute;&gt; &amp; more."}.get(kind, f"<{kind}>{inner}</{kind}>"))
    title = sentence(5)
    noise = [
        lambda: f"<nav><ul>{''.join(f'<li><a href=/{word()}>{word()}</a>' for _ in range(6))}</ul></nav>",
        lambda: f"<div class='{rnd.choice(['ad', 'ad-banner', 'sponsored box', 'promo'])}'><p>{sentence(20)}</p></div>",
        lambda: f"<aside><h3>{word()}</h3><p>{sentence(30)}</p></aside>",
        lambda: f"<div class='{rnd.choice(['cookie-notice', 'newsletter', 'social share', 'related-posts'])}'>{sentence(12)}</div>",
        lambda: f"<section id=comments><div class=comment><p>{sentence(25)}</p></div><div class='comment-body'>{sentence(9)}</div></section>",
        lambda: f"<form action=/s><label>{word()}</label><input name=q><button>{word()}</button></form>",
        lambda: f"<script>if (a < b) x('<p>{word()}</p>')</script><style>p {{ margin: 0 }}</style><!-- <p>{word()}</p> -->",
        lambda: f"<div style='display: none'><p>{sentence(22)}</p></div><svg/>",
    ]
    some = lambda n: "".join(rnd.choice(noise)() for _ in range(rnd.randint(0, n)))
    main = f"<h1>{title}</h1>" + "".join(b + (some(1) if rnd.random() < 0.3 else "") for b in body)
    tag = rnd.choice(["article", "main", "div class='entry-content'", "div id=content", "section role=main", "div class=post"])
    inner = rnd.choice(["{}", "<div class='text'>{}</div>", "<div class='notice-free text'>{}</div>", "<div class='row'>{}</div>"]).format(main)
    page = f"<{tag}>{inner}</{tag.split()[0]}>"
    wrap = rnd.choice(["{}", "<div class='has-sidebar'>{}</div>", "<div class='page no-sidebar'><div>{}</div></div>", "<div class='col-text with-menu'>{}</div>", "<div id=wrapper>{}</div>"])
    page = f"<html><head><title>{title}</title></head><body><header><p>{sentence(15)}</p></header>{some(3)}{wrap.format(page)}{some(3)}<footer>&copy; {sentence(20)}</footer>"
    return page, " ".join([title, *blocks])


def test_main_text_of_generated_pages():
    rnd = random.Random(21)
    pages = [generated_page(rnd) for _ in range(500)]
    assert [p for p, t in pages if maintext.extract(p)[0] != t] == []


def test_minimum_cut_against_all_labels():
    rnd = random.Random(7)
    for _ in range(150):
        n = rnd.randint(1, 7)
        s = [rnd.choice([-3, -1, 0, 1, 2, 5]) * rnd.random() for _ in range(n)]
        e = [(a, b, rnd.random() * 2) for a, b in itertools.combinations(range(n), 2) if rnd.random() < 0.4]

        def cost(label, s=s, e=e):
            return sum(max(x, 0) if not k else max(-x, 0) for x, k in zip(s, label, strict=True)) + sum(c for a, b, c in e if label[a] != label[b])

        best = min(cost(x) for x in itertools.product([False, True], repeat=n))
        assert cost(maintext.minimum_cut(s, e)) == pytest.approx(best)


def test_many_blocks():
    page = "<article>" + f"<p>{LONG}</p><p>x</p><nav>y</nav>" * 4000 + "</article>"
    text, blocks, kept = maintext.extract(page)
    assert (blocks, kept) == (12_000, 8_000) and text.count(LONG) == 4000


def test_pages_edges(spark):
    rows = [(1, "u", None), (None, None, ""), (2, "u", f"<p>{LONG}"), (2, "u", f"<p>{LONG}"), (3, "u", "é" * 200_000)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = maintext.main_text(d).collect()
    assert len(got) == 5 and [r["text"] for r in got if r["page_id"] == 2] == [LONG, LONG]
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert maintext.main_text(d.filter("false")).count() == 0


# --- near duplicates --------------------------------------------------------------------------------


def corpus():
    rnd = random.Random(11)
    vocabulary = ["".join(rnd.choices("abcdefghijklmnop", k=rnd.randint(2, 8))) for _ in range(3000)]
    text = lambda n: rnd.choices(vocabulary, k=n)
    rows = [(i, " ".join(text(rnd.randint(1, 300)))) for i in range(150)]

    def edited(words, share):
        return " ".join(rnd.choice(vocabulary) if rnd.random() < share else w for w in words)

    base, passage = text(200), text(60)
    rows += [(1000 + i, edited(base, 0.01)) for i in range(120)] + [(2000, " ".join(base))]
    rows += [(3000 + i, " ".join(text(20) + passage + text(20))) for i in range(60)]
    for g in range(12):
        b = text(rnd.randint(30, 400))
        rows += [(4000 + 10 * g + k, edited(b, 0.008 * k)) for k in range(5)]
    long = text(30_000)
    rows += [(5000, " ".join(long)), (5001, "\n".join(edited(long, 0.005).split())), (5002, " ".join(text(15_000) + long[:15_000]))]
    rows += [(6000, "spam " * 500), (6001, "spam " * 480), (6002, "spam " * 300), (6003, "a b"), (6004, "a  b\n"), (6005, None), (6006, ""), (6006, ""), (None, "spam " * 500), (6007, "x y z w v"), (6008, "x y z w")]
    # One doc_id with two texts, and a near copy of the second.
    other = text(90)
    rows += [(7000, " ".join(text(80))), (7000, " ".join(other)), (7001, " ".join(other[:-1]))]
    return rows


def brute_classes(rows):
    """Class of each row, by all pairs of rows."""
    words = near.Words()
    x = [near.labelled_kmers(words.of(t or "")[0]) for _, t in rows]
    parent = list(range(len(rows)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in itertools.combinations(range(len(rows)), 2):
        if root(a) != root(b) and near.aligned(x[a], x[b]):
            parent[root(a)] = root(b)
    classes = {}
    for k, (i, _) in enumerate(rows):
        classes.setdefault(root(k), []).append(i)
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in classes.items()}
    return [least[root(k)] for k in range(len(rows))]


def test_near_classes_against_all_pairs(spark):
    rows = corpus()
    want = brute_classes(rows)
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"keys": F.lit(1), "digest": F.lit("clash"), "id": F.lit(2), "raw": F.lit(0), "gone_id": F.lit(3)})
    got = near.near_rows(d.repartition(3)).join(spark.createDataFrame([(i, t or "") for i, t in rows], "i long, t string").distinct(), F.expr("raw = xxhash64(t) and doc_id <=> i")).collect()
    assert len(got) == len(rows)
    expected = {(i, t or ""): c for (i, t), c in zip(rows, want, strict=True)}
    have = {(r["i"], r["t"]): r["class_id"] for r in got}
    assert have == expected
    assert len({c for (i, _), c in have.items() if i and 3000 <= i < 3060}) == 60
    sizes = {c: want.count(c) for c in want}
    assert all(r["class_size"] == sizes[r["class_id"]] for r in got if r["class_id"] != 7000)
    # One text of each class stays: of its least doc_id.
    assert {(r["doc_id"], r["kept"]) for r in got if r["doc_id"] in (6000, 6001, None, 7001)} == {(6000, True), (6001, False), (None, False), (7001, False)}
    # Both texts of 7000 are the first of a class.
    assert len({r["class_id"] for r in got if r["kept"]}) == len(set(want)) and {r["class_size"] for r in got if r["i"] == 7000} == {1, 2}
    out = near.drop_near_copies(d)
    assert out.columns == d.columns
    kept = sorted((r["doc_id"], r["text"] or "") for r in out.collect())
    assert kept == sorted((r["i"], r["t"]) for r in got if r["kept"])
    assert [i for i, _ in kept].count(7000) == 2 and [i for i, _ in kept].count(6006) == 0


def test_null_ids_only(spark):
    d = spark.createDataFrame([(None, "one two three"), (None, "one two  three"), (None, "four five")], "doc_id long, text string")
    got = near.near_classes(d).collect()
    assert [r["class_id"] for r in got] == [None] * 3 and sorted(r["class_size"] for r in got) == [1, 2, 2]
    assert near.drop_near_copies(d).count() == 2


def test_near_links_between_texts_that_lead_no_bucket(spark):
    """All texts share a passage of just less than the threshold; two and two share three more words, so their only
    common buckets are large and most lead none of them."""
    rnd = random.Random(5)
    text = lambda n: ["".join(rnd.choices("abcdefghijklmnop", k=7)) for _ in range(n)]
    passage = text(178)
    rows = []
    for g in range(60):
        both = text(3)
        rows += [(10 * g + k, " ".join(passage + both + text(19))) for k in range(2)]
    want = {(10 * g, 10 * g + 1) for g in range(60)}
    assert brute_classes(rows) == [i // 10 * 10 for i, _ in rows]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("raw", F.xxhash64("text"))
    got = {r["doc_id"]: r["class_id"] for r in near.near_classes(d).collect()}
    assert got == {i: i // 10 * 10 for i, _ in rows}
    # Small blocks find the same pairs as one.
    words = near.words_of(d, d.select(F.col("doc_id").alias("id"), "doc_id", "raw"))
    nodes = near.kmers_of(words.withColumn("root", F.col("id")))
    one, many = ({tuple(r) for r in near.rest_pairs(nodes, block=b).collect()} for b in (1000, 7))
    assert one == many and one >= want


def test_thousands_of_near_copies(spark):
    """3,000 copies of one text, which is not there itself, with one to three edits each: many are below the threshold to
    most others, so classes depend on single links. All pairs by a product of incidence matrices."""
    rnd = random.Random(12)
    base = ["".join(rnd.choices("abcdefghijklmnop", k=6)) for _ in range(80)]
    rows = []
    for i in range(3000):
        w = list(base)
        for at in rnd.choices(range(80), k=rnd.randint(1, 3)):
            w[at] = f"{rnd.choice('xyz')}{rnd.randint(0, 3)}"
        rows.append((i, " ".join(w)))
    words = near.Words()
    x = [near.labelled_kmers(words.of(t)[0]) for _, t in rows]
    _, at = np.unique(np.concatenate(x), return_inverse=True)
    held = np.zeros((len(rows), at.max() + 1), np.float32)
    held[np.repeat(np.arange(len(rows)), [len(k) for k in x]), at] = 1
    common, size = held @ held.T, held.sum(1)
    linked = common >= 0.8 * (size[:, None] + size[None, :] - common) - 1e-6
    want = np.arange(len(rows))
    while True:
        least = np.where(linked, want[None, :], len(rows)).min(1)
        if (least == want).all():
            break
        want = least
    got = {r["doc_id"]: r["class_id"] for r in near.near_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert len(set(want.tolist())) > 20
    assert [got[i] for i in range(len(rows))] == want.tolist()


def test_prefixes_of_linked_texts_meet():
    rnd = random.Random(8)
    for _ in range(300):
        n = rnd.randint(1, 40)
        a = rnd.sample(range(60), n)
        b = set(a) - set(rnd.sample(a, rnd.randint(0, n // 4))) | set(rnd.sample(range(60), rnd.randint(0, n // 4)))
        if b and len(set(a) & b) >= near.SIMILARITY * len(set(a) | b):
            first = lambda s: set(sorted(s)[: near.prefix_length(len(s))])
            assert first(set(a)) & first(b)


def test_profiles_bound_common_kmers():
    a = near.labelled_kmers(np.arange(500, dtype=np.uint32))
    b = near.labelled_kmers(np.arange(250, 750, dtype=np.uint32))
    least = np.minimum(*(np.frombuffer(near.profile(x), np.uint8).astype(int) for x in (a, b)))
    assert least.sum() >= len(np.intersect1d(a, b))
    assert near.profile(near.labelled_kmers(np.arange(60_000, dtype=np.uint32))) == b""


def test_alignment_is_sensitive_to_order():
    rnd = random.Random(3)
    w = np.array([rnd.getrandbits(32) for _ in range(400)], np.uint32)
    a = near.labelled_kmers(w)
    assert near.aligned(a, a) == 1.0
    assert near.aligned(a, near.labelled_kmers(np.concatenate([w[200:], w[:200]]))) == 0.0
    b = w.copy()
    b[[50, 150, 250]] = 1
    assert 0.8 < near.aligned(a, near.labelled_kmers(b)) < 1


def test_labels_are_distinct():
    x = near.labelled_kmers(np.full(3000, 7, np.uint32))
    assert len(set(x.tolist())) == len(x) == 2996


def test_sketches_keep_order():
    rnd = random.Random(9)
    w = np.array([rnd.getrandbits(32) for _ in range(300)], np.uint32)
    a, b = near.sketch_keys(near.labelled_kmers(w)), near.sketch_keys(near.labelled_kmers(w[::-1].copy()))
    assert not set(a.tolist()) & set(b.tolist())
    edited = w.copy()
    edited[100] = 5
    assert len(set(a.tolist()) & set(near.sketch_keys(near.labelled_kmers(edited)).tolist())) >= 10


def test_components_of_chains(spark):
    ids = list(range(60))
    random.Random(2).shuffle(ids)
    rows = list(zip(ids[:40], ids[1:40], strict=False)) + [(100, 101), (101, 102), (102, 100), (7, 7)]
    got = {r["id"]: r["root"] for r in near.components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert len({got[i] for i in ids[:40]}) == 1 and len({got[100], got[101], got[102]}) == 1 and got[100] != got[ids[0]]


def test_empty_table(spark):
    assert near.near_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0
