"""Chat formatting, quality rules, exact dedup, mixing: against plain Python and on edge cases."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tablewright.llm import chat, exact, mixing, quality
from tablewright.llm.shared import hot_keys, join_groups

DOC = "doc_id long, text string, lang string, source string, n_chars long, words string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None, "clash") for i, t, s in rows], DOC).withColumns({"recipe": F.lit(1), "host": F.lit("x"), "keys": F.lit(2)})


ODD = [None, "", " \n\t", "a", "é ü x", "a b c d e f g h i j k l", "w " * 3000, "x" * 100_000, "\\l\\b<|end|>#", "same text here", "same text here"]


# --- chat -------------------------------------------------------------------------------------------


def test_escape_round_trip(spark):
    texts = ["\\l", "<|start|>user\n", "\\\\h#\\b", "<", "a\\", *[t for t in ODD if t is not None]]
    d = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = d.select("t", chat.escape(F.col("t")).alias("e")).select("t", "e", chat.unescape(F.col("e")).alias("u"), chat.unescape_role(chat.escape_role(F.col("t"))).alias("r")).collect()
    for r in rows:
        assert r["u"] == r["r"] == r["t"] and "<" not in r["e"] and "#" not in r["e"]


def test_prefix_targets_read_back(spark):
    convs = {
        1: [(0, "system", "be good"), (1, "user", "hi <|end|>\n"), (2, "assistant", "he\\llo"), (3, "user", None), (4, "assistant", "bye#"), (5, "user", "tail")],
        2: [(0, "user", "alone")],
        3: [(0, "assistant", ""), (1, "assistant", "x" * 5000)],
        None: [(None, None, None), (0, "assistant", "z")],
        4: [(0, "user", "a"), (0, "user", "a"), (1, "assistant", "b")],
    }
    d = spark.createDataFrame([(c, *t, 7) for c, ts in convs.items() for t in ts], "conv_id long, turn long, role string, text string, body int")
    examples = chat.prefix_target_examples(d).collect()
    assert Counter(e["conv_id"] for e in examples) == {1: 3, 2: 1, 3: 2, None: 1, 4: 1}
    for e in examples:
        if e["conv_id"] == 1 and e["example"] == 0:
            assert e["text"][e["loss_start"] : e["loss_start"] + e["loss_chars"]] == "he\\bllo" and "bye" not in e["text"]
    got = {r["conv_id"]: r for r in chat.format_and_read_back(d).collect()}
    for c, turns in convs.items():
        ts = [(r or "", t or "") for _, r, t in sorted(turns, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "", x[2] or ""))]
        loss = "".join(t for r, t in ts if r == "assistant")
        assert got[c]["n_turns"] == len(ts)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in ts).encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.format_and_read_back(d.filter("false")).count() == 0


# --- quality ----------------------------------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_quality(rows):
    out, lines_of, content, words_of = {}, {}, {}, {}
    for k, (_, text, host) in enumerate(rows):
        text = text or ""
        w = WORD.findall(text)
        grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        n = Counter(grams)
        cover = {i + j for i, g in enumerate(grams) if n[g] > 1 for j in range(5)}
        full = [x for x in text.split("\n") if WORD.search(x)]
        content[k] = " ".join(w).lower()
        lines_of[k], words_of[k] = [" ".join(WORD.findall(x)).lower() for x in full], len(w)
        base = len(w) < 10 or 100 * len(cover) > 20 * len(w)
        out[k] = [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(full) - len(set(full)), len(cover), base]
    held = defaultdict(set)
    for k, (_, _, host) in enumerate(rows):
        for x in lines_of[k]:
            held[host, x].add(content[k])
    for k, (_, _, host) in enumerate(rows):
        lost = sum(len(x.split(" ")) for x in lines_of[k] if len(held[host, x]) > 20)
        left = words_of[k] - lost
        out[k].append(not out[k][5] and not (lost and (left < 10 or 4 * left < words_of[k])))
    return out


COOKIE = "Accepting cookies helps us, zzzzzzzz policy of this site"


def quality_rows():
    rows = [(i, t, "h1") for i, t in enumerate(ODD)]
    common = "Subscribe to our LETTER now please"
    for i in range(40):
        own = " ".join(f"w{i}x{j}longword" for j in range(8 if i % 4 == 0 else 15))
        rows.append((100 + i, f"{own}\n{common}  " if i % 2 else f"{own}\n subscribe to  our letter now please", "h2"))
    rows += [(200 + i, "copied document with quite a few different words in one long line\nand a second line of text", "h2") for i in range(60)]
    # Copies with other white space, lines and rows are still one document.
    rows += [(260 + i, "copied document with quite a few different words in one long line\n" + "\n" * i + " and  a second line of text", "h2") for i in range(30)]
    rows += [(300, "one two three four five six seven\n" * 6, None), (301, None, None), (None, "a b c d e f g h i j k l m", None)]
    # One line of a host in different documents, between others, with extreme words in the line itself.
    rows += [(400 + i, f"body {i} has words of its own {i * i} and more\n\n{COOKIE}\nend of document number {i} comes here", "h3") for i in range(40)]
    # The same line in as many documents as the limit allows.
    rows += [(500 + i, f"body {i} has words of its own {i * i} and more\n{COOKIE}", "h4") for i in range(20)]
    # Depleted pages that share one notice of a hundred words; a null host is another host than an empty one.
    notice = " ".join(f"notice{i}" for i in range(100))
    rows += [(600 + i, f"{notice}\n" + " ".join(f"a{i}b{j}" for j in range(12)), ("h5", None, "")[i % 3]) for i in range(90)]
    # A line twice in a document counts once and goes twice; null and repeated ids.
    rows += [(None if i % 2 else 700, f"{COOKIE}\nsome body text {i} of the page which is long enough to stay\n{COOKIE}", "h6") for i in range(30)]
    rows += [(800, "word " + "x" * 50_000 + "\n" + f"{COOKIE}\n" * 3000 + "tail", "h6")] * 2
    return rows


def test_quality_against_plain_python(spark):
    rows = quality_rows()
    got = quality.verdicts(docs(spark, rows).withColumns({"unit": F.lit("clash"), "removed": F.lit(1), "lines": F.lit(2)}), carry=("n_chars",))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    have = Counter((r["doc_id"], *[r[c] for c in names]) for r in got.collect())
    assert have == Counter((rows[k][0], *v) for k, v in brute_quality(rows).items())
    kept = {r["doc_id"] for r in got.filter("kept").collect()}
    assert {200, 259, 260, 289} <= kept and 100 not in kept and 101 in kept
    assert not kept & set(range(600, 690)) and set(range(400, 440)) <= kept


def brute_clean(rows):
    verdict, held = brute_quality(rows), defaultdict(set)
    plain = lambda x: " ".join(WORD.findall(x)).lower()
    for _, text, host in rows:
        words = plain(text or "")
        for x in (text or "").split("\n"):
            held[host, plain(x)].add(words)
    return sorted((i or -1, "\n".join(x for x in t.split("\n") if not plain(x) or len(held[h, plain(x)]) <= 20)) for k, (i, t, h) in enumerate(rows) if verdict[k][-1])


def test_clean_removes_lines_and_keeps_columns(spark):
    rows = quality_rows()
    d = docs(spark, rows)
    c = quality.clean(d)
    assert c.columns == d.columns
    got = c.collect()
    assert sorted((r["doc_id"] or -1, r["text"]) for r in got) == brute_clean(rows)
    text = {r["doc_id"]: r["text"] for r in got}
    assert "letter" not in text[101].lower() and "w1x0longword" in text[101]
    assert COOKIE not in text[400] and COOKIE in text[500] and text[400].count("\n") == 2
    assert quality.clean(d.filter("false")).count() == 0


# --- exact ------------------------------------------------------------------------------------------


def test_exact_against_plain_python(spark):
    long = "Sentence one, with commas. " * 700
    rows = [(i, t, "s") for i, t in enumerate(ODD)] + [(50, long, "s"), (51, long.replace(" ", "\n"), "s"), (52, long + " ", "s"), (53, long[:-2], "s"), (54, long + " ", "s"), (None, "same text here", "s"), (90, "same  text here", "s"), (91, "A b", "s"), (92, "Ab ", "s")]
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i))
    got = exact.exact_groups(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    want = Counter()
    for norm, members in groups.items():
        best = min(members)
        for n, _, i in members:
            want[i, best[2], len(members), (i, n) == (best[2], best[0]), hashlib.sha256(norm.encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in got) == want
    assert exact.exact_groups(docs(spark, rows).filter("false")).count() == 0


def test_chunks_follow_content(spark):
    import random

    rnd = random.Random(4)
    text = " ".join("".join(rnd.choices("etaoinshrdlucmfwypvbgk", k=rnd.randint(2, 9))) for _ in range(6000))
    d = docs(spark, [(1, text, "s"), (2, "Something in front! " + text[:20000] + "!" + text[20000:], "s")])
    r = {x["doc_id"]: [c["id"] for c in x["recipe"]] for x in exact.recipes(d).collect()}
    assert len(set(r[1]) & set(r[2])) > 0.5 * len(r[1])
    dictionary = exact.chunk_dictionary(exact.recipes(d))
    assert dictionary.filter("NOT verified").count() == 0 and dictionary.agg(F.sum("uses")).first()[0] == len(r[1]) + len(r[2])


def test_drop_copies_row_by_row(spark):
    rows = [(1, "x y", "s"), (None, "xy", "s"), (None, "unique text", "s"), (7, "x  y z", "s"), (9, "xyz", "s"), (9, "only here", "s"), (4, None, "s"), (5, "", "s"), (5, "", "s"), (6, "twin", "s"), (6, "twin", "s")]
    d = docs(spark, rows).withColumns({"raw": F.lit(0), "gone_id": F.lit(1), "kept": F.lit(True)})
    out = exact.drop_copies(d)
    assert out.columns == d.columns
    stay = Counter((r["doc_id"], r["text"]) for r in out.collect())
    assert stay == Counter([(1, "x y"), (None, "unique text"), (7, "x  y z"), (9, "only here"), (4, None), (6, "twin"), (6, "twin")])
    assert exact.drop_copies(d.filter("false")).count() == 0


# --- mixing -----------------------------------------------------------------------------------------


def brute_levels(nodes, budget):
    """Water level by repeated shares: nodes name -> (cap, weight)."""
    out, open_, left = {}, dict(nodes), budget
    while open_:
        w = sum(x[1] for x in open_.values())
        full = {k: c for k, (c, v) in open_.items() if c * w <= v * max(left, 0)}
        if not full:
            return out | {k: v * max(left, 0) // w for k, (_, v) in open_.items()}
        k = min(full, key=lambda k: (open_[k][0] / open_[k][1], k))
        out[k] = open_[k][0]
        left -= open_.pop(k)[0]
    return out


def test_water_level(spark):
    import random

    rnd = random.Random(5)
    rows, want = [], {}
    for p in range(40):
        nodes = {f"n{j}": (rnd.choice([0, 1, 5, 50, 1000]), rnd.randint(1, 5)) for j in range(rnd.randint(1, 7))}
        budget = rnd.randint(0, sum(c for c, _ in nodes.values()) + 20)
        rows += [(p, k, c, w, budget) for k, (c, w) in nodes.items()]
        want |= {(p, k): v for k, v in brute_levels(nodes, budget).items()}
    d = spark.createDataFrame(rows, "parent int, name string, cap long, weight long, budget long")
    got = {(r["parent"], r["name"]): r["budget"] for r in mixing.water_fill(d, ["parent"], "name").collect()}
    assert got == want


def mix(spark, rows, total, **kw):
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, domain string, slot int")
    return mixing.select_by_budget(d, F.col("domain"), F.lit(total), {"source": {"a": 3}}, slots=8, **kw).collect()


def test_mixing_budgets_and_epochs(spark):
    rows = [(i, "w " * 10, "en", "a" if i % 2 else "b", "d", 0) for i in range(40)]
    got = mix(spark, rows, 200)
    by = Counter(r["source"] for r in got)
    assert by == {"a": 15, "b": 5} and {r["epoch"] for r in got} == {0}
    # 375 and 125 tokens; the document in which a budget ends comes whole.
    got = mix(spark, rows, 500, max_epochs=2)
    assert Counter((r["source"], r["epoch"]) for r in got) == {("a", 0): 20, ("a", 1): 18, ("b", 0): 13}
    # a holds 400 in two epochs; what it lacks of 525 goes to its sibling.
    got = mix(spark, rows, 700, max_epochs=2)
    assert Counter((r["source"], r["epoch"]) for r in got) == {("a", 0): 20, ("a", 1): 20, ("b", 0): 20, ("b", 1): 10}
    assert len({(r["doc_id"], r["epoch"]) for r in got}) == len(got)


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None, 1)], [(1, "a b", None, "s", None, 1), (1, "a b", None, "s", None, 1)]])
def test_mixing_edges(spark, rows):
    got = mix(spark, rows, 100, max_epochs=2)
    assert all(r["domain"] == "" and r["lang"] == "" for r in got)
    assert len(got) == {0: 0, 1: 0, 2: 4}[len(rows)]


def test_keep_selected_row_by_row(spark):
    # Two documents without an id, of three tokens each, and a budget of three: one stays.
    d = docs(spark, [(None, "one two three", "s"), (None, "four five six", "s")]).withColumns({"tie": F.lit(0), "picked_id": F.lit(0)})
    out = mixing.keep_selected(d, F.lit("x"), F.lit(3), {})
    assert out.columns == d.columns and out.count() == 1
    # One id with two texts: each has a place of its own. Rows that are alike stay or go together.
    d = docs(spark, [(5, f"{w} two three", "s") for w in "abcdefgh"])
    assert mixing.keep_selected(d, F.lit("x"), F.lit(12), {}).count() == 4
    d = docs(spark, [(5, "one two three", "s")] * 4 + [(6, None, None), (None, "", "s")])
    assert mixing.keep_selected(d, F.lit("x"), F.lit(3), {}).filter("doc_id = 5").count() in (0, 4)
    long = docs(spark, [(1, "w " * 400_000, "s"), (2, "w", "s")])
    assert {r["doc_id"]: r["n_tokens"] for r in mixing.select_by_budget(long, F.lit("x"), F.lit(400_001), {}).collect()} == {1: 400_000, 2: 1}


def test_default_weights_of_null_names(spark):
    rows = [(i, "w " * 10, None if i % 2 else "en", None, None, 0) for i in range(40)]
    got = mix(spark, rows, 200)
    assert Counter(r["lang"] for r in got) == {"": 10, "en": 10}


def test_keep_selected_keeps_columns(spark):
    d = docs(spark, [(i, "one two three", f"s{i % 3}") for i in range(30)])
    out = mixing.keep_selected(d, F.lit("x"), F.expr("all_tokens div 2"), {})
    assert out.columns == d.columns and 13 <= out.count() <= 18


@pytest.mark.parametrize("hot", [1, 4, 1000])
def test_join_groups(spark, hot):
    keys = ["a"] * 50 + ["b"] * 20 + [f"k{i}" for i in range(30)]
    rows = spark.createDataFrame(list(enumerate(keys)), "id long, key string")
    groups = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    found = hot_keys(groups, "key", "n", len(keys), hot)
    # Keys of more than all rows, of more than a quarter, of more than a thousandth.
    assert {r.key for r in found.collect()} == {1: set(), 4: {"a"}, 1000: set(keys)}[hot]
    n = Counter(keys)
    assert sorted(map(tuple, join_groups(rows, groups, "key", found).select("id", "key", "n").collect())) == [(i, k, n[k]) for i, k in enumerate(keys)]
