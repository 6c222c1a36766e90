"""Chats, pages, secrets, toxicity, quality and packing."""

import base64
import gzip
import itertools
import math
import random
import re
import urllib.parse
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.llm import chat, packing, pages, quality, secrets, toxicity as tox
from tabforge.llm.queries import INJECTED

# ---- chats ------------------------------------------------------------------


def formatted(df):
    out = chat.format_chats(df)
    out = out.withColumn("back", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.read_loss(F.col("segments")))
    return out.orderBy("id").collect()


def turns(row):
    return [tuple(t) for t in row]


def test_layouts_become_the_same_turns(spark):
    both = [("user", "hi"), ("assistant", "yes")]
    schema = """id int, extra string, messages array<struct<role:string,content:string,name:string>>, conversations array<struct<`from`:string,value:string>>,
      instruction string, input string, output string, prompt string, completion string, response string, question string, answer string, system string"""
    names = ["id", "extra", "messages", "conversations", "instruction", "input", "output", "prompt", "completion", "response", "question", "answer", "system"]
    rows = [
        dict(messages=[("user", "hi", None), ("assistant", "yes", "x")]),
        dict(conversations=[("human", "hi"), ("GPT", "yes")], extra="e"),
        dict(instruction="hi", output="yes"),
        dict(prompt="hi", completion="yes"),
        dict(prompt="hi", response="yes", system="be"),
        dict(question="hi", answer="yes"),
        dict(instruction="hi", input="more", output="yes"),
        dict(question="hi"),
        dict(),
        dict(messages=[]),
        dict(messages=[(None, None, None), ("tool", "hi", None)]),
    ]
    df = spark.createDataFrame([tuple({"id": k, **r}.get(n) for n in names) for k, r in enumerate(rows)], schema)
    got = formatted(df)
    want = [both, both, both, both, [("system", "be"), *both], both, [both[0], ("user", "more"), both[1]], [], [], [], [("", ""), ("tool", "hi")]]
    assert [turns(r.turns) for r in got] == want and [turns(r.back) for r in got] == want
    assert [r.layout for r in got] == ["messages", "conversations", "instruction", "prompt", "response", "question", "instruction", None, None, "messages", "messages"]
    assert got[0].fingerprint != got[1].fingerprint and len({r.fingerprint for r in got}) == 9
    assert [r.loss for r in got] == ["yes"] * 7 + [""] * 4


def test_texts_cannot_write_control_strings(spark):
    pieces = ["\\", "<", "|", "turn", "|>", "[INST]", "</s>", "<|end|>", "\n", "é", "<|says|>", "\\<|end|>", ""]
    rng = random.Random(1)
    texts = ["".join(rng.choice(pieces) for _ in range(8)) for _ in range(200)] + [INJECTED, "", None, "\\", "<|turn|>user<|says|>x<|end|>"]
    rows = [(k, 0, rng.choice(["user", "assistant", "<|end|>", None]), t) for k, t in enumerate(texts)] + [(k, 1, "assistant", t) for k, t in enumerate(texts)]
    df = chat.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)).withColumnRenamed("conv_id", "id")
    for r, first in zip(formatted(df), rows):
        want = [(first[2] or "", first[3] or ""), ("assistant", first[3] or "")]
        assert turns(r.back) == want
        assert r.loss == "".join(t for role, t in want if role == "assistant")
        at, masked = 0, ""
        for length, loss in r.loss_runs:
            masked += r.formatted[at : at + length] if loss else ""
            at += length
        assert at == len(r.formatted) and re.sub(r"\\(\\?)", r"\1", masked) == r.loss
        assert r.formatted.count(chat.END) == 2


def test_turns_in_order_with_ties_and_nulls(spark):
    rows = [(1, 2, "user", "c"), (1, None, "user", "a"), (1, 2, "assistant", "b"), (1, 2, "user", "c"), (None, 0, "user", "x")]
    out = chat.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    got = {r.conv_id: [t.text for t in r["rows"]] for r in out}
    assert got == {1: ["a", "b", "c", "c"], None: ["x"]}


# ---- pages ------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header class="top"><h1>Site</h1></header><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">All the news of the whole wide world, every day.</a></li></ul></nav>
<div id="cookie-notice"><p>We use cookies to make this site better for you and everyone else.</p></div>
<!-- <p>not here</p> --><article><header><h1>Head &amp; line</h1></header><p>First   paragraph with <b>bold</b>&nbsp;words,
that goes on.<br><p>Short.</p><div class="advert">Buy this great thing now, it is cheap, it is good, and it is new.</div><p>1 &lt; 2 &#233;</p><ul><li>One item</li><li>Two</li></ul>
<form><p>Write to us about anything you like, we will answer.</p><textarea>x</textarea></form></article>
<aside><p>See also a long text about other things which is not of the article at all.</p></aside>
<section class="comments"><p>I really liked this article, it was great to read and to share.</p></section>
<footer>&copy; 2020 by someone, all rights reserved, and so on and on.</footer></body></html>"""
MAIN = "Head & line\nFirst paragraph with bold words, that goes on.\nShort.\n1 < 2 é\nOne item\nTwo"


def test_main_text(spark):
    plain_page = "<div>Menu</div><div class='x'><p>" + "A sentence of some words that is long enough. " * 3 + "</p><p>Yes.</p><p>" + "More of the same, and then some more words. " * 3 + "</p></div><div class=footer><a href=x>About</a></div>"
    long = "<article>" + "".join(f"<p>Paragraph {k} of the text.</p>" for k in range(3000)) + "</article>"
    broken = "<p>Text that is never closed, of a page that ends in a <b"
    df = spark.createDataFrame([(1, PAGE), (1, PAGE), (2, None), (3, ""), (4, plain_page), (5, long), (6, broken), (None, "just words in no element at all, but many of them.")], "page_id long, html string")
    got = [r.main.text for r in pages.extract(df.withColumn("main", F.lit(1)).withColumn("text", F.lit("t"))).collect()]
    assert got[:4] == [MAIN, MAIN, "", ""]
    beside = "<div class='page has-sidebar'><p>" + "A sentence of some words that is long enough. " * 3 + "</p></div>"
    assert pages.main_text(beside)[0].startswith("A sentence")
    assert got[4].split("\n")[1] == "Yes." and "Menu" not in got[4] and "About" not in got[4] and got[4].count("\n") == 2
    assert got[5].count("\n") == 2999
    assert got[6] == "Text that is never closed, of a page that ends in a <b" and got[7].startswith("just words")


PARAGRAPHS = [f"This is paragraph {k} of the article, long enough to be the running text that a reader came for, with nothing linked in it." for k in range(4)]


@pytest.mark.parametrize(
    "frame",
    [
        '<article class="post comments-open">{}</article>',
        '<article class="post-promo story">{}</article>',
        '<div class="page sidebar-right"><article>{}</article><div class="sidebar"><p>{beside}</p></div></div>',
        '<main><div class="legal-text">{}</div></main>',
        '<div id="comments-closed"><div class="entry">{}</div></div>',
        '<div class="wrap sidebar-left ad-free share-enabled"><section>{}</section></div>',
        '<form id="aspnetForm"><div>{}</div></form>',
        '<div class="layout menu-open"><main>{}</main><ol class="comment-list"><li><article class="comment-body"><p>{beside}</p></article></li></ol></div>',
        '<article>{}<div class="comments"><p>{beside}</p><p>{beside}</p></div></article>',
        '<article>{}</article><aside><article><p>{beside}</p></article></aside>',
        '<article>{}<div class="promo-box"><p>{beside}</p></div></article><div class="cookie-notice"><p>{beside}</p></div>',
        '<article>{}</article><section class="comments">' + "<p>{beside}</p>" * 12 + "</section>",
    ],
)
def test_class_names_take_no_article_and_boilerplate_stays_out(frame):
    """Names of states on what holds the article do not count; the same names on other parts do."""
    beside = "Something else that stands beside the article, also long enough to look like running text to a reader."
    page = "<html><body><nav><a href='/'>Home</a></nav>" + frame.format("".join(f"<p>{p}</p>" for p in PARAGRAPHS), beside=beside) + "<footer>Terms of use and more.</footer></body></html>"
    assert pages.main_text(page)[0].split("\n") == PARAGRAPHS


def test_an_advert_longer_than_a_short_article_stays_out():
    page = "<div class='ad'>An advert of one long block, which is more running text than the short article has in all.</div><article><h1>A title here</h1><p>Two words.</p></article>"
    assert pages.main_text(page)[0] == "A title here\nTwo words."


def test_smoothness_overrules_a_name():
    """A short block with a bad name between paragraphs goes with them or not by the cut alone."""
    scores = [3.0, -0.9, 3.0]
    assert pages.minimum_cut(scores, [(0, 1, 0.6), (1, 2, 0.6)]) == [True, True, True]


def test_elements_that_are_not_closed_cut_no_page():
    paragraphs = ["A sentence of some words that is long enough to be read here.", "Another one, of about as many words, that must not be lost either."]
    article = "<article>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</article>"
    for tag in ("button", "select", "svg", "iframe", "object", "canvas", "audio", "video", "noscript", "template"):
        for page in (
            f"<body><{tag}>Menu{article}</body>",
            f"<body><div><{tag}>Menu</div>{article}</body>",
            f"<body><{tag}>Menu{article}<{tag}>Share</{tag}></body>",
            f"<body><div><{tag}>Menu</div>{article}<div>Share</{tag}></div></body>",
            f"<body><{tag}>Menu{article}<div>Share</{tag}></div></body>",
            f"<body><{tag}><div>Menu</div></{tag}>{article}</body>",
            f"<body>{article.replace('</p>', f'<{tag}>Menu</p>')}</body>",
            f"<body>{article.replace('</p>', f'<{tag}>Menu</{tag}></p>')}</body>",
        ):
            assert pages.main_text(page)[0].split("\n") == paragraphs, page
    assert pages.main_text("<title>T <textarea>" + article)[0].endswith("\n".join(paragraphs)[-40:])


def test_formulas_are_kept():
    page = "<article><p>We know that <math><mi>E</mi><mo>=</mo><mi>mc</mi></math> holds for all of the cases that are listed here.</p></article>"
    assert pages.main_text(page)[0] == "We know that E=mc holds for all of the cases that are listed here."


def test_minimum_cut_is_least():
    rng = random.Random(4)
    for _ in range(200):
        n = rng.randint(1, 8)
        terminal = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 2)) for a in range(n) for b in range(a) if rng.random() < 0.5]

        def cost(kept):
            own = sum(t for t, k in zip(terminal, kept) if t > 0 and not k) - sum(t for t, k in zip(terminal, kept) if t < 0 and k)
            return own + sum(c for a, b, c in edges if kept[a] != kept[b])

        assert cost(pages.minimum_cut(terminal, edges)) == pytest.approx(min(cost(k) for k in itertools.product([False, True], repeat=n)))


def test_smoothness_decides_weak_blocks():
    assert pages.minimum_cut([2.0, -0.5, 2.0], [(0, 1, 0.6), (1, 2, 0.6)]) == [True, True, True]
    assert pages.minimum_cut([2.0, -1.5, 2.0], [(0, 1, 0.6), (1, 2, 0.6)]) == [True, False, True]


# ---- secrets ----------------------------------------------------------------

SECRET = 'token = "abcdef123456'


def plain_scan(text):
    found = [("assign", m) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A) if len(m[2]) >= 6]
    found += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", m) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(((k, m.start(), m.end()) for k, m in found), key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def test_base_spans_match_the_patterns():
    rng = random.Random(6)
    pieces = ["token", "SECRET", "api_key", "ApiKey", "passwd", "password", ":", "=", " ", '"', "'", "abc", "x1", "-._/", "AKIA", "A" * 9, "0f" * 7, "deadbeef", "é", "K", "ſecret", "\n"]
    for _ in range(5000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert sorted(secrets.scan(text), key=secrets._order) == plain_scan(text)


def layers(text):
    return secrets.scan_layers(text, secrets.scan(text))


def test_layers_are_unwrapped_and_mapped_back():
    quoted, b64 = urllib.parse.quote(SECRET), base64.b64encode(SECRET.encode()).decode()
    cases = {
        "é " + quoted + " x": quoted,
        "".join(f"\\u{ord(c):04x}" for c in SECRET): None,
        "&#116;oken = abcdef1": None,
        f"so {b64} it": b64,
        "so " + base64.b64encode(gzip.compress(SECRET.encode())).decode() + ".": base64.b64encode(gzip.compress(SECRET.encode())).decode(),
        "".join(f"%{c:02x}" for c in base64.b64encode(zlib.compress(quoted.encode()))): None,
        base64.b64encode(base64.b64encode(b64.encode())).decode(): None,
    }
    for text, part in cases.items():
        ((kind, start, end),) = layers(text)[0]
        assert kind == "assign" and text[start:end] == (part or text), text
    assert layers("%2525252541")[1] == 6  # each layer once, until nothing is new
    assert layers(SECRET)[0] == [("assign", 0, len(SECRET))]
    for text in ("", "%", "%zz\\u12", "&#99999999;", "A" * 64, "\\ud800", "%ff%fe"):
        assert layers(text)[0] == []


def test_find_and_redact(spark):
    b64 = base64.b64encode(SECRET.encode()).decode()
    long = "word " * 50_000 + SECRET
    rows = [(1, f"a {SECRET}\" b {b64}"), (1, f"a {SECRET}\" b {b64}"), (2, None), (None, ""), (3, long)]
    out = secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string").withColumn("secrets", F.lit(0)))
    got = out.select("*", secrets.joined("secrets.spans").alias("s")).collect()
    assert [r.s for r in got] == [f"assign:2:23,assign:27:{27 + len(b64)}"] * 2 + ["", "", f"assign:250000:{250000 + len(SECRET)}"]
    assert [len(r.secrets.base) for r in got] == [1, 1, 0, 0, 1]
    again = secrets.find_secrets(out.drop("secrets"), redact=True).collect()
    assert [r.secrets.redacted for r in again] == ['a [assign]" b [assign]'] * 2 + ["", "", "word " * 50_000 + '[assign]']
    assert [r.secrets.spans for r in again] == [r.secrets.spans for r in got]


def test_an_encoded_secret_that_stands_twice(spark):
    plain = base64.b64encode(SECRET.encode()).decode()
    packed = base64.b64encode(gzip.compress(SECRET.encode(), mtime=0)).decode()
    twice = base64.b64encode(plain.encode()).decode()
    for runs in ([plain, plain], [packed, "x", packed], [plain, packed, twice, plain]):
        text = " é ".join(runs)
        own = [r for r in runs if r != "x"]
        assert [text[lo:hi] for _, lo, hi in layers(text)[0]] == own
        (row,) = secrets.find_secrets(spark.createDataFrame([(text,)], "text string"), redact=True).collect()
        assert row.secrets.redacted == " é ".join("x" if r == "x" else "[assign]" for r in runs)
    escaped = urllib.parse.quote(plain, safe="").replace("=", "%3D") + " " + plain
    assert len(layers(escaped)[0]) == 2


@pytest.mark.parametrize("odd", ["\u00a0", "\u00ad", "\f", "\u200b", b"\xff"])
def test_layers_that_are_not_all_readable(odd):
    odd = odd if isinstance(odd, bytes) else odd.encode()
    run = base64.b64encode(b"one line " + odd + b" " + SECRET.encode()).decode()
    assert layers(f"so {run} it")[0] == [("assign", 3, 3 + len(run))]


@pytest.mark.parametrize("glue", ["", "a/", "ab-", "key-", "path_", "a/b/", "a-long-word/"])
def test_runs_that_are_glued_to_a_word(glue):
    for data in (SECRET.encode(), zlib.compress(SECRET.encode()), gzip.compress(SECRET.encode())):
        run = glue + base64.b64encode(data).decode()
        assert layers(f"so {run} it")[0] == [("assign", 3, 3 + len(run))], (glue, data)


@pytest.mark.parametrize("size", [100, 1000, 50_000_000])
def test_compressed_layers_of_any_size(size, monkeypatch):
    monkeypatch.setattr(secrets, "LAYER_CHARS", size)
    monkeypatch.setattr(secrets, "CHUNK", 64)
    words = b"word " * 700
    deep = base64.b64encode(zlib.compress(words + urllib.parse.quote(SECRET).encode(), 0))
    cases = [words + SECRET.encode(), words + b"token" + b" " * 3000 + b"= abcdefgh", words + deep, words + b"x/" + deep, words + b"\\x74oken=abcdefgh " + words]
    for data in cases:
        half = len(data) // 2
        for packed in (zlib.compress(data), gzip.compress(words) + gzip.compress(data), gzip.compress(data[:half]) + gzip.compress(data[half:])):
            run = base64.b64encode(packed).decode()
            spans, _, cut = layers(f"so {run} it")
            assert spans == [("assign", 3, 3 + len(run))] and not cut
    broken = base64.b64encode(gzip.compress(words + SECRET.encode() + words)[:-9]).decode()
    assert len(layers(broken)[0]) == 1
    assert layers(base64.b64encode(gzip.compress(words * 20)).decode())[0] == []


# ---- toxicity ---------------------------------------------------------------


def test_segments_are_all_maximal_ones():
    rng = random.Random(8)
    for _ in range(300):
        w = np.array([rng.choice([-3, -2, -1, 1, 2, 4]) for _ in range(rng.randint(1, 30))])
        total = np.concatenate([[0], np.cumsum(w)])
        at = np.flatnonzero(w > 0)
        got = sorted((lo, hi) for lo, hi, _ in tox.maximal_segments(at, w[at], total[at]))

        def split(lo, hi):  # by definition: the best segment (shortest, first), then both sides
            best = max(((total[b] - total[a], -(b - a), -a, a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=None)
            return [] if best is None or best[0] <= 0 else [*split(lo, best[3]), (best[3], best[4]), *split(best[4], hi)]

        assert got == sorted(split(0, len(w)))


def toxic_rows(rng, n, share=0.25):
    neutral, bad = [f"word{i}" for i in range(300)], ["awful", "rotten", "vile"]
    rows, labels = [], []
    for i in range(n):
        own = [rng.choice(neutral) for _ in range(rng.randint(5, 200))]
        label = int(rng.random() < share)
        if label:
            at = rng.randrange(len(own))
            own[at:at] = [rng.choice(bad) + rng.choice(["", "ly", "ness"]) for _ in range(3)]
        rows.append((i, " ".join(own)))
        labels.append((i, 1, label))
    return rows, labels


def test_toxicity_on_held_out_rows(spark, documents):
    rows, labels = toxic_rows(random.Random(9), 400)
    rows += [(10_000, None), (10_001, ""), (None, "word1 vile word2"), (5, rows[5][1])]
    table = spark.createDataFrame([*labels, (None, 1, 1), labels[3], (77_777, 0, None)], "doc_id long, quality int, toxic int")
    out = tox.toxicity(documents(rows), table).select("*", tox.held_out("doc_id").alias("held")).collect()
    truth = {i: y for i, _, y in labels}
    held = [r for r in out if r.held and r.doc_id in truth]
    assert len(out) == len(rows) and len(held) > 60
    assert all(r.held == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95
    assert all(0 <= r.toxicity.score <= 1 for r in out)
    empty = {r.toxicity.score for r in out if r.doc_id in (10_000, 10_001)}
    assert len(empty) == 1 and empty.pop() < 0.3
    assert any(r.toxicity.passages for r in out if r.predicted)


def test_a_lexicon_of_any_size_scores_alike(spark):
    rows, labels = toxic_rows(random.Random(11), 300)
    letters = str.maketrans("0123456789", "abcdefghij")
    rows = [(i, f"{t} rare{i // 2}x".translate(letters)) for i, t in rows]
    labelled = spark.createDataFrame([(t, y) for (_, t), (_, _, y) in zip(rows, labels)], "text string, toxic int").repartition(3)
    docs = spark.createDataFrame([*rows, (None, None), (7, ""), (7, rows[7][1])], "doc_id long, text string")
    small, large = tox.fit(labelled), tox.fit(labelled, 10)
    assert isinstance(large.lexicon, tox.LexiconTable) and large.lexicon.table.count() == len(small.lexicon.hashes) > 300
    assert large.curve == pytest.approx(small.curve, rel=1e-6) and large.decay == pytest.approx(small.decay)
    scores = [sorted((r.doc_id or -1, r.text or "", r.toxicity.score) for r in m.score(docs.withColumn("toxicity", F.lit(1))).collect()) for m in (small, large)]
    assert [s[:2] for s in scores[0]] == [s[:2] for s in scores[1]]
    assert [s[2] for s in scores[0]] == pytest.approx([s[2] for s in scores[1]], rel=1e-5)


def test_a_large_lexicon_keeps_columns_of_any_name(spark, documents):
    rows, labels = toxic_rows(random.Random(12), 200)
    labelled = spark.createDataFrame([(t, y) for (_, t), (_, _, y) in zip(rows, labels)], "text string, toxic int")
    docs = documents([*rows, (None, None), (7, "")])
    small, large = ({(r.doc_id, r.text): r for r in tox.fit(labelled, size).score(docs).collect()} for size in (10**6, 10))
    assert small.keys() == large.keys() and len(small) == len(rows) + 2
    for k, r in large.items():
        assert r.toxicity.score == pytest.approx(small[k].toxicity.score, rel=1e-5) and r.asDict().keys() == small[k].asDict().keys()
        assert (r["_text"], r["_block"], r["row"], r["own"], r["n"]) == ("_text", "_block", "row", "own", "n")


def test_toxicity_with_labels_of_one_kind(spark, documents):
    table = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in tox.toxicity(documents([(1, "a b"), (2, None)]), table).collect()} == {0}
    none = tox.toxicity(documents([(1, "a b")]), table.limit(0)).collect()
    assert none[0].toxicity.score == pytest.approx(0.5)


def test_held_out_labels_are_never_used(spark, documents):
    rows, labels = toxic_rows(random.Random(10), 200)
    flip = [(i, q, 1 - y) if zlib.crc32(str(i).encode()) % 4 == 2 else (i, q, y) for i, q, y in labels]
    scores = [
        {r.doc_id: r.toxicity.score for r in tox.toxicity(documents(rows), spark.createDataFrame(t, "doc_id long, quality int, toxic int")).collect()} for t in (labels, flip)
    ]
    assert scores[0] == pytest.approx(scores[1], rel=1e-9)


# ---- quality ----------------------------------------------------------------


def test_quality_leans_sparse_sites_on_their_host(spark):
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(600):
        site, good = ("good.example", 0.95) if i % 3 else ("bad.example", 0.2)
        label = int(rng.random() < good)
        text = " ".join(rng.choice(["one", "two", "three", "four"]) + str(rng.randrange(99)) for _ in range(40)) if label else "BUY!! " * 40
        rows.append((i, text, f"https://{site}/p{i % 2}/x"))
        labels.append((i, label, 0))
    rows += [(9000, "", "http://new.example/a/b"), (9001, None, None), (9002, rows[0][1], "good.example"), (None, rows[0][1], "https://bad.example/p0/x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n", F.lit(1)).withColumn("host", F.lit("x"))
    out = quality.quality(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), section=None).collect()
    assert len(out) == len(rows)
    truth = {i: q for i, q, _ in labels}
    held = [r for r in out if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert sum(r.keep == truth[r.doc_id] for r in held) / len(held) > 0.95
    by = {r.doc_id: r for r in out}
    assert by[1].host == "good.example" and by[1].path == "good.example/p1" and by[9001].host == ""
    assert by[1].path_posterior > 0.8 > 0.4 > by[0].path_posterior
    mean = sum(r.p_text for r in out) / len(out)
    assert by[9000].path_posterior == pytest.approx(mean, abs=0.02)  # nothing else is known of it
    assert by[9002].path_posterior == pytest.approx(by[9002].host_posterior)  # a path of its own


def test_quality_of_empty_tables(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.quality(documents([]), labels).collect() == []
    assert quality.quality(documents([(1, "a")]), labels).collect()[0].score == pytest.approx(0.5, abs=0.01)


# ---- packing ----------------------------------------------------------------


def plain_bins(plan):
    bins = {}
    for length, first, last, bin_, each, offset in plan.slots:
        for r in range(first, last + 1):
            bins.setdefault(bin_ + (r - first) // each, []).append((offset + (r - first) % each * length, length, (length, r)))
    return bins


def test_plans_place_every_piece_once():
    rng = random.Random(12)
    for _ in range(150):
        capacities = rng.choice([(512, 1024, 2048, 4096), (10,), (7, 20, 33)])
        sizes = {}
        for _ in range(rng.choice([1, 5, 50, 1500])):
            length = min(max(capacities), max(1, int(rng.lognormvariate(5 if max(capacities) > 100 else 2, 1))))
            sizes[length] = sizes.get(length, 0) + 1
        plan = packing.plan_bins(list(sizes.items()), capacities)
        bins, size = plain_bins(plan), {b: (c, u) for lo, hi, c, u in plan.groups for b in range(lo, hi + 1)}
        assert bins.keys() == size.keys()
        for b, items in bins.items():
            at = 0
            for offset, length, _ in sorted(items):
                assert offset == at
                at += length
            assert size[b] == (min(c for c in capacities if c >= at), at)
        placed = [p for items in bins.values() for _, _, p in items]
        assert sorted(placed) == sorted((n, r) for n, c in sizes.items() for r in range(c))


def test_one_capacity_is_best_fit_decreasing():
    rng = random.Random(13)
    for _ in range(100):
        lengths = [rng.randint(1, 50) for _ in range(rng.randint(1, 200))]
        rooms = []
        for n in sorted(lengths, reverse=True):
            fit = min((r for r in rooms if r >= n), default=None)
            rooms.append((rooms.pop(rooms.index(fit)) if fit is not None else 60) - n)
        sizes = [(n, lengths.count(n)) for n in set(lengths)]
        got = sorted(60 - u for lo, hi, _, u in packing.plan_bins(sizes, (60,)).groups for _ in range(hi - lo + 1))
        assert got == sorted(rooms)


def test_pack(documents):
    rng = random.Random(14)
    rows = [(k, " ".join("w" * rng.randint(1, 3) for _ in range(rng.choice([0, 1, 7, 7, 7, 40, 130])))) for k in range(300)]
    rows += [(None, None), (None, "a b"), (5, rows[5][1]), (1000, "x " * 1000)]
    out = packing.pack(documents(rows), capacities=(16, 64), rank_rows=20).collect()
    words = {}
    for r in out:
        words[r.doc_id] = words.get(r.doc_id, 0) + r.length
    want = {}
    for doc_id, text in rows:
        want[doc_id] = want.get(doc_id, 0) + len((text or "").split())
    assert words == want
    bins = {}
    for r in out:
        assert (r.bin is None) == (r.length == 0)
        if r.length:
            bins.setdefault(r.bin, []).append(r)
    for items in bins.values():
        at = 0
        for r in sorted(items, key=lambda r: r.bin_offset):
            assert r.bin_offset == at
            at += r.length
        assert at == items[0].used <= items[0].capacity and items[0].capacity == min(c for c in (16, 64) if c >= at)
    assert sorted(bins) == list(range(len(bins)))
    used, room = sum(i[0].used for i in bins.values()), sum(i[0].capacity for i in bins.values())
    assert used / room > 0.95
    assert sorted(r.start for r in out if r.doc_id == 1000) == [64 * k for k in range(math.ceil(1000 / 64))]
    assert packing.pack(documents([])).collect() == []
