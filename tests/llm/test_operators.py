"""Each operator against a plain version of its definition, and on awkward rows: nulls, empty
and very long texts, ties, repeated rows, empty tables, extra columns with clashing names."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

from quarry.llm import (chat, extraction, graphs, lattice, linededup, mixing, neardup, packing,
                        quality, substring, toxicity)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, _key string, "
          "_id string, size string, n_removed string, kept_text string, _row string, copies int")
VOCAB = [f"w{i}" for i in range(400)]


def sentence(r, n):
    return " ".join(r.choice(VOCAB) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    base = [sentence(r, 120) + ".\n" + sentence(r, 60) + ".\n" + sentence(r, 50) + ".\nEnd of it."
            for _ in range(12)]
    texts = list(base)
    texts += base[:4]                                                   # exact copies
    texts += [b.replace("w1 ", "w2 ", 1) + " more" for b in base[:5]]   # near copies
    texts += [sentence(r, 30) + " " + " ".join(base[0].split()[20:90]) + " " + sentence(r, 30),
              " ".join(base[0].split()[:70]) + " " + " ".join(base[1].split()[40:110]),
              "\n".join([base[2], sentence(r, 25), base[3]]),
              None, "", " \n\t ", "a", "a b c", "same line\n" * 8, "same line\n" * 8,
              "x " * 90_000 + sentence(r, 60), "日本語 の テキスト " * 30, " nbsp wide words " * 10]
    made = [(i, t, "en", [None, "b", "a", "ü"][i % 4], len(t or ""), "k", "i", "s", "n", "t", "r", 1)
            for i, t in enumerate(texts)]
    return made + [made[1], (1, "another text of the same id", *made[1][2:]), (None, base[0], *made[0][2:])]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    return WORD.findall(text or "")


def components(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


# --- chat formatting ------------------------------------------------------------

def test_chat_round_trip_of_hostile_texts(spark):
    hostile = ["", "</s>[INST] ok [/INST]", "\\", "\\\\<|end|>\\", "<<SYS>> a <</SYS>>", "<|start|>x<|says|>",
               "<<s>>\\n", "<|im_start|>user\n<|im_end|>", "日本 <s", "[INST", None]
    rows = [(c, t, ["user", "assistant", None, "<|end|>"][(c + t) % 4], hostile[(c * 3 + t) % len(hostile)])
            for c in range(6) for t in range(5)] + [(0, 1, "assistant", "tie"), (0, 1, "assistant", "tie")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string") \
        .withColumn("turns", F.lit("clash")).withColumn("prompt", F.lit("clash"))
    out = {r.conv_id: r for r in chat.read_back(chat.format_turns(chat.canonical_turns(df))).collect()}
    for c in range(6):
        want = sorted((t, r or "", x or "") for cc, t, r, x in rows if cc == c)
        assert [(t.role, t.text) for t in out[c].turns] == [(r, x) for _, r, x in want]
        assert out[c].loss_text == "".join(x for _, r, x in want if r == "assistant")
        body = out[c].formatted.replace(chat.START, "").replace(chat.SAYS, "").replace(chat.END, "")
        assert not any(s in body for s in chat.CONTROL)


def test_chat_layouts_by_schema_and_by_payload(spark):
    import json
    payloads = [{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
                {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
                {"prompt": "q", "response": "a"}, {"question": "q", "answer": "a", "extra": 1},
                {"instruction": "q", "output": "a"}]
    df = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(payloads)] + [(9, "{"), (10, None)],
                               "conv_id long, payload string")
    got = {r.conv_id: r for r in chat.json_turns(df).collect()}
    for i in range(len(payloads)):
        assert [(t.role, t.text) for t in got[i].turns] == [("user", "q"), ("assistant", "a")]
    assert got[0].layout == "messages" and got[9].layout is None and got[10].turns == []
    for i, p in enumerate(payloads):
        one = spark.read.json(spark.sparkContext.parallelize([json.dumps({"conv_id": i, **p})]))
        turns = chat.canonical_turns(one).first().turns
        assert [(t.role, t.text) for t in turns] == [("user", "q"), ("assistant", "a")]
    with pytest.raises(ValueError):
        chat.canonical_turns(spark.range(1).withColumnRenamed("id", "conv_id"))


# --- quality ----------------------------------------------------------------------

def plain_features(text):
    text = text or ""
    w = words_of(text)
    starts = defaultdict(list)
    for i in range(len(w) - 7):
        starts[tuple(w[i:i + 8])].append(i)
    hit = {i + k for s in starts.values() if len(s) > 1 for i in s for k in range(8)}
    lines = [x for x in text.split("\n") if words_of(x)]
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(hit))


def test_quality_features_match_their_definition(docs, rows):
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                  for r in quality.quality_features(docs).collect())
    assert got == Counter((r[0], *plain_features(r[1])) for r in rows)


def test_quality_posteriors_equal_a_plain_estimation(docs):
    judged = quality.judge(quality.quality_features(docs)).collect()
    votes = [[int(d) - 1 for d in r.votes] for r in judged]
    accuracy, prior, good, before = [0.85] * len(quality.RULES), 0.8, None, None
    for _ in range(100):
        good = []
        for v in votes:  # document by document
            up, down = prior, 1 - prior
            for a, x in zip(accuracy, v):
                if x:
                    up, down = up * (a if x > 0 else 1 - a), down * (1 - a if x > 0 else a)
            good.append(up / (up + down))
        moved = before is None or max(abs(a - b) for a, b in zip(good, before)) > 1e-9
        before = good
        for k in range(len(accuracy)):
            cast = [(g if v[k] > 0 else 1 - g) for v, g in zip(votes, good) if v[k]]
            accuracy[k] = min(max((sum(cast) + 20 * 0.85) / (len(cast) + 20), 0.6), 0.995)
        prior = min(max((sum(good) + 20 * 0.8) / (len(good) + 20), 0.05), 0.95)
        if not moved:
            break
    assert len({r.votes for r in judged}) > 3
    for r, g in zip(judged, good):
        assert abs(r.posterior - g) < 1e-6 and r.kept == (not r.base_failed and r.posterior >= 0.5)


def test_quality_keeps_prose_and_rejects_junk(spark, empty):
    r = random.Random(5)
    good = [sentence(r, 90) + "." for _ in range(60)]
    junk = [" ".join(w + "***" for w in sentence(r, 60).split()) + "." for _ in range(8)]
    junk += [sentence(r, 50).upper().replace(" ", "!! ") + "!!" for _ in range(8)]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(good + junk)], "doc_id long, text string, _key string")
    kept = quality.filter_quality(df)
    assert kept.columns == df.columns
    assert {x.doc_id for x in kept.collect()} == set(range(len(good)))
    assert quality.filter_quality(empty).count() == 0


# --- substring and line dedup -------------------------------------------------------

def test_substring_dedup_is_exact(docs, rows, empty):
    span, known = 50, {}
    for r in rows:
        w = words_of(r[1])
        for i in range(len(w) - span + 1) if r[0] is not None else ():
            key = tuple(w[i:i + span])
            known[key] = min(known.get(key, r[0]), r[0])
    want = Counter()
    for r in rows:
        w = words_of(r[1])
        gone = {i + k for i in range(len(w) - span + 1) if r[0] is not None
                and known[tuple(w[i:i + span])] < r[0] for k in range(span)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        want[r[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    found = substring.repeated_spans(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found) == want
    assert all(sum(s.length for s in r.spans) == r.n_removed for r in found)
    assert substring.repeated_spans(empty).count() == 0


def line_windows(lines, least):
    """(first line, last line) of the shortest run with ``least`` words from each line on."""
    out = []
    for i in range(len(lines)):
        for j in range(i, len(lines)):
            if sum(len(words_of(x)) for x in lines[i:j + 1]) >= least:
                out.append((i, j))
                break
    return out


@pytest.mark.parametrize("least", [8, 1, 40])
def test_line_dedup_is_exact(docs, rows, empty, least):
    keyed = sorted({(r[0] is not None, r[0] or 0, r[1] or "") for r in rows})
    lines = {key: [x for x in key[2].split("\n") if words_of(x)] for key in keyed}
    places = defaultdict(list)
    for key in keyed:
        for i, j in line_windows(lines[key], least):
            places[tuple(lines[key][i:j + 1])].append((key[0], key[1], key, i))
    got = {(r.doc_id, r.n_lines): r for r in linededup.dedup_lines(docs, min_words=least).collect()}
    removed = 0
    for key in keyed:
        if key[1] == 1 or not key[0]:
            continue  # repeated id, null id: order among themselves is by key
        gone = set()
        for i, j in line_windows(lines[key], least):
            same = places[tuple(lines[key][i:j + 1])]
            if min(p[:2] for p in same) < key[:2] or any(p[2] == key and p[3] < i for p in same):
                gone |= set(range(i, j + 1))
        assert got[key[1], len(lines[key])].n_removed == len(gone), key[1]
        removed += len(gone)
    assert removed
    if least == 8:
        out = linededup.dedup_documents(docs)
        assert out.columns == docs.columns and out.where("n_chars <> length(text) AND doc_id <> 1").count() == 0
        assert linededup.dedup_documents(empty).count() == 0


def test_single_lines_and_short_runs_are_found(spark):
    licence = "this text may be used by anyone for any purpose at all whatsoever"
    texts = ["one two three\n" + licence + "\nfour five six", licence, "a b c d\n" + licence + "\n\nq",
             "short one here\nand a second line\nthen more", "x\nshort one here\nand a second line\ny", "short one here"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r.kept_text for r in linededup.dedup_lines(df, min_words=7).collect()}
    assert got == {0: texts[0], 1: "", 2: "a b c d\n\nq", 3: texts[3], 4: "x\ny", 5: texts[5]}


def thue_morse(n, one, two):
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join((one, two)[b] for b in bits), "".join((two, one)[b] for b in bits)


def test_texts_that_collide_under_a_polynomial_stay_apart(spark):
    one, two = thue_morse(2048, "a", "b")
    df = spark.createDataFrame([(1, one), (2, two), (3, f"{one}\n{two}"), (4, one)], "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links) for r in neardup.jaccard_classes(df).collect()}
    assert got == {1: (1, 1), 2: (2, 0), 3: (3, 0), 4: (1, 1)}
    lines = {r.doc_id: r.n_removed for r in linededup.dedup_lines(df, min_words=1).collect()}
    assert lines == {1: 0, 2: 0, 3: 2, 4: 1}
    fill = " ".join(f"x{i}" for i in range(49))
    df = spark.createDataFrame([(1, f"{one} {fill}"), (2, f"{two} {fill}"), (3, f"{one} {fill}")], "doc_id long, text string")
    spans = {r.doc_id: r.n_removed for r in substring.repeated_spans(df).collect()}
    assert spans == {1: 0, 2: 0, 3: 50}
    w_one, w_two = thue_morse(2048, "a ", "b ")
    df = spark.createDataFrame([(1, w_one), (2, w_two)], "doc_id long, text string")
    assert neardup.jaccard_classes(df).select("class_id").distinct().count() in (1, 2)
    from quarry.llm.hashing import digest
    assert neardup.sequence_hash(w_one.encode()) != neardup.sequence_hash(w_two.encode()) and len(digest(b"")) == 16


# --- extraction -----------------------------------------------------------------------

def test_extraction_takes_the_article_only(spark):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head>
      <body class="with-sidebar"><header><h2>Site</h2></header><nav><ul><li><a href="/">Home</a></ul></nav>
      <div class="cookie-notice"><p>We use cookies for many long reasons that nobody ever reads.</p></div>
      <article><h1>Head &amp; line</h1><p>First <b>bold</b>   text<br>here &copy; &#233;.<p>Second, un<i>broken</i>.
      <form><input><button>Go</button></form><aside>Side</aside><div class="ad">Buy</div>
      <div id="comments"><p>first! reader comment that is quite long, longer than the article itself, honestly.</p></div>
      </article><footer>&copy; us</footer></body></html>"""
    want = "Head & line First bold text here © é. Second, unbroken."
    df = spark.createDataFrame([(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "no tags"),
                                (5, "u", page[:page.index("<aside>")]), (5, "u", page),
                                (6, "u", "<div>" * 3000 + "deep" + "</div>" * 10)],
                               "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = Counter((r.page_id, r.text, r.n_chars) for r in extraction.extract(df).collect())
    assert got == Counter([(1, want, len(want)), (2, "", 0), (3, "", 0), (4, "no tags", 7), (5, want, len(want)),
                           (5, want, len(want)), (6, "deep", 4)])
    assert extraction.extract(df.limit(0)).count() == 0


def test_extraction_of_pages_without_and_with_several_articles():
    long = "<p>" + "many words of the first part, " * 20 + "</p>"
    short = "<p>a second part.</p><p>its end.</p>"
    links = "<div>" + "".join(f"<a href='{i}'>link {i}</a>" for i in range(9)) + "</div>"
    two = f"<article>{long * 2}</article><article>{short}</article>"
    for body in (f"<main>{two}</main>", two, f"<div>{two}</div>{links}",
                 f"<article>{long}</article><div>{long}</div><article>{short}</article>"):
        text = extraction.main_text(f"<html><body>{body}</body></html>")
        assert text.count("first part") == 40 and text.endswith("a second part. its end.") and "link" not in text
    text = extraction.main_text(f"<html><body><div><h2>Head</h2>{long * 2}</div>{links}</body></html>")
    assert text.startswith("Head many words") and text.count("first part") == 40 and "link" not in text


def test_extraction_leaves_out_whole_names_only():
    text = "<h2>Head</h2>" + "<p>words of the main text, and more of them.</p>" * 5
    want = "Head" + " words of the main text, and more of them." * 5
    for name in ("has-sidebar", "content-sidebar-wrap", "post share-enabled", "no-ads", "sidebar"):
        page = f"<body><div class='{name}'>{text}</div><div class='ad-box'>Buy</div></body>"
        assert extraction.main_text(page) == want, name
    page = f"<body><div id='related-work'>{text}</div><div id=siteFooter>us</div><nav>n</nav></body>"
    assert extraction.main_text(page) == want
    page = ("<body><article><p>a</p><p class='notice'>b</p><p class='footer-note'>c</p><math><mi>x</mi></math>"
            "<object>d</object><map>e</map><dialog>f</dialog><div id='comments'>" + "talk " * 99 + "</div></article></body>")
    assert extraction.main_text(page) == "a b c x d e f"


def test_extraction_leaves_out_comments_and_teasers_with_articles():
    comment = ('<li class="comment"><article class="comment-body"><footer>ann</footer><p>' + "a long reader comment, " * 30
               + "</p></article></li>")
    for before, after in (("", ""), ("<main>", "</main>"), ("<div class='page'>", "</div>")):
        page = f"""<body><header><h1>Site</h1></header>{before}<article><h1>Head</h1>
          <p>The article text, of some length, goes on for a while.</p><p>More of it here.</p>
          <div class="post-header"><p>its own head</p></div></article>
          <div id="comments"><h2>2 comments</h2><ol>{comment * 2}</ol></div>
          <section class="related-posts"><article><h1>Teaser</h1><p>{"a teaser for another story, " * 9}</p></article></section>
          <div class="post-footer">tags</div><div class="cookie-policy">cookies</div>
          <div class="user-comment"><p>me too</p></div><section class="comment-section"><p>first</p></section>{after}
          <footer>us</footer></body>"""
        assert extraction.main_text(page) == ("Head The article text, of some length, goes on for a while. "
                                              "More of it here. its own head"), before


def test_an_article_elsewhere_must_be_dense_enough():
    long = "<p>" + "many words of the first part, " * 20 + "</p>"
    far = "<div><span><a href='/'>x</a></span><article><b>t</b><i>u</i><b>v</b></article></div>"
    text = extraction.main_text(f"<body><article>{long * 3}</article>{far}</body>")
    assert text.count("first part") == 60 and not text.endswith("v")


def test_extraction_reads_awkward_markup_in_linear_time():
    pages = {"name": "<div " + "a" * 200_000 + ">x</div>", "names": "<div " + "a " * 100_000 + ">x</div>",
             "values": "<div " + "a=" * 100_000 + ">x</div>", "gap": "<div a" + " " * 200_000 + "b>x",
             "headers": "<header>" * 10_000 + "x", "in article": "<article>" + "<header>" * 10_000 + "x",
             "scope": "<p><button>" + "<b>" * 10_000 + "<div>x" * 5_000, "quotes": "<p '>" * 20_000,
             "open tags": "<a" * 50_000, "angles": "<" * 100_000}
    for name, page in pages.items():
        start = time.time()
        extraction.main_text(page)
        assert time.time() - start < 2, name


# --- toxicity -----------------------------------------------------------------------------

def test_toxicity_learns_words_and_prefixes(spark, empty):
    r = random.Random(1)
    made, labels = [], []
    for i in range(400):
        w = sentence(r, 60).split()
        toxic = i % 4 == 0
        for k in range(3 if toxic else 0):
            w[r.randrange(60)] = "vilest" if i % 8 else "hate" + r.choice("abcdefgh") + "ful"
        made.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    d = spark.createDataFrame(made + [(1000, None), (1001, "")], "doc_id long, text string")
    lab = spark.createDataFrame(labels + [(3, None), (None, 1)], "doc_id long, toxic int")
    got = {x.doc_id: x.score for x in toxicity.score(d, lab, F.col("doc_id") % 5 != 0).collect()}
    held = [i for i in range(0, 400, 5)]
    assert np.mean([(got[i] >= 0.5) == (i % 4 == 0) for i in held]) >= 0.95
    assert got[1000] == got[1001] and 0 <= got[1000] <= 1 and len(got) == 402
    none = toxicity.score(d, lab.limit(0), F.lit(True)).select("score").distinct().collect()
    assert [x.score for x in none] == [0.0]
    assert toxicity.score(empty, lab, F.lit(True)).count() == 0


def test_toxicity_reads_whole_words_and_texts_without_spaces(spark):
    r = random.Random(8)
    for text in ("z" * 25, "日本語" * 30 + "x", "é" * 40 + " kurz " + "a日" * 17, "ab\u00a0cd，ef", "𝒳" * 9):
        low = toxicity.lowered(text.encode())
        starts, ends = toxicity.word_spans(np.frombuffer(low, np.uint8))
        pieces = [low[a:b].decode() for a, b in zip(starts, ends)]  # no character is cut
        assert all(len(p.encode()) <= toxicity.LONGEST for p in pieces)
        assert {k for a, b in zip(starts, ends) for k in range(a, b)} == {k for k, c in enumerate(low) if c != 32}
    buf = np.frombuffer(b"counterrevolutionary counterrevolutionists", np.uint8)
    rows = toxicity.gram_rows(buf, *toxicity.word_spans(buf))
    assert (rows[0] != rows[1]).any()

    made, labels = [], []
    for i in range(400):  # no space anywhere; the telling word stands late
        text = "".join(chr(0x4E00 + r.randrange(600)) for _ in range(120))
        made.append((i, text[:60 + i % 50] + ("鬱陶憎悪" if i % 4 == 0 else "") + text[60 + i % 50:]))
        labels.append((i, int(i % 4 == 0)))
    got = {x.doc_id: x.score for x in toxicity.score(
        spark.createDataFrame(made, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, toxic int"), F.col("doc_id") % 5 != 0).collect()}
    assert np.mean([(got[i] >= 0.5) == (i % 4 == 0) for i in range(0, 400, 5)]) >= 0.95


def test_toxicity_gradients():
    net = toxicity.Network(np.zeros(0, np.uint64), np.zeros(toxicity.GRAM_ROWS, bool))
    r = np.random.default_rng(0)
    x = r.standard_normal((30, toxicity.WORD_DIM + toxicity.CHAR_DIM)).astype(np.float32)
    w = r.integers(0, 30, (6, toxicity.WIDTH))
    w[0, 5:] = -1
    y, weight = np.array([1, 0, 1, 0, 0, 1.0]), np.ones(6)
    g, _ = net.gradients(x, w, y, weight)

    def loss():
        z = net.forward(x.astype(np.float64), w).astype(float)
        return float((np.log1p(np.exp(z)) - y * z).mean())
    for name in ("uf", "ub", "wf", "wb", "cf", "attend", "focus", "out"):
        p = net.p[name]
        at = tuple(0 for _ in p.shape)
        old = p[at]
        p[at] = old + 1e-2
        high = loss()
        p[at] = old - 1e-2
        low = loss()
        p[at] = old
        assert abs((high - low) / 2e-2 - float(np.asarray(g[name])[at])) < 2e-3, name


# --- joins on pairs ---------------------------------------------------------------------------

def test_jaccard_join_is_exact(docs, rows, empty):
    sets = []
    for r in rows:
        w = words_of(r[1])
        k = min(5, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w and r[0] is not None else set())
    pairs = [(a, b) for a in range(len(rows)) for b in range(a)
             if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    degree = Counter(x for p in pairs for x in p)
    comp = components(len(rows), pairs)
    low = {}
    for i, c in enumerate(comp):
        low[c] = min(low.get(c, rows[i][0]), rows[i][0]) if rows[i][0] is not None else None
    want = Counter((r[0], low[comp[i]], degree[i]) for i, r in enumerate(rows))
    for block in (512, 2):
        got = neardup.jaccard_classes(docs, block_rows=block)
        assert Counter((r.doc_id, r.class_id, r.n_links) for r in got.collect()) == want
    kept = neardup.one_per_class(docs)
    assert kept.columns == docs.columns
    # one row per class of documents with words, and every distinct document without any
    first = {}
    for i, r in enumerate(rows):
        if sets[i]:
            first[comp[i]] = min(first.get(comp[i], r[0]), r[0])
    bare = {(r[0], r[1]) for i, r in enumerate(rows) if not sets[i] and r[0] is not None}
    assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == sorted(
        [*first.values(), *(i for i, _ in bare)])
    assert neardup.one_per_class(empty).count() == 0


def test_one_per_class_keeps_unrelated_texts_of_one_id(spark):
    a, b = (" ".join(f"{p}{i}" for i in range(30)) for p in "ab")
    rows = [(5, a), (5, b), (5, ""), (6, a + " more"), (7, b), (5, a), (None, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.text) for r in neardup.one_per_class(df).collect())
    assert got == Counter([(5, a), (5, b), (5, ""), (None, a)])


def test_prefix_depth_reaches_the_target_recall():
    d = neardup.prefix_depth(0.8, 20, 12, 0.999)
    assert 1 - (1 - 0.8 ** d) ** 20 >= 0.999 > 1 - (1 - 0.8 ** (d + 1)) ** 20


def test_tries_link_every_entry_to_the_first_of_its_node(spark):
    r = random.Random(9)
    entries = [(t, bytes(r.choice([0, 0, 0, 1]) for _ in range(16)), 1000 * t + i) for t in range(3) for i in range(400)]
    df = spark.createDataFrame(entries, "tree int, key binary, rep long")
    for depth in (1, 3, 8):
        got = neardup._tries(df, depth).collect()
        nodes = defaultdict(list)
        for t, key, rep in entries:
            nodes[t, key[:2 * depth]].append(rep)
        names = {x: k for k, xs in nodes.items() for x in xs}
        assert all(names[e.rep] == names[e.hub] and e.level >= depth for e in got)
        linked = components(3000, [(e.rep, e.hub) for e in got])
        assert all(len({linked[x] for x in xs}) == 1 for xs in nodes.values())
        assert len(got) == sum(len(xs) - 1 for xs in nodes.values())


def test_forest_finds_similar_sets_at_its_depth():
    r = np.random.default_rng(3)
    forest = neardup.Forest(neardup.TREES, neardup.LONGEST_PREFIX)
    depth = neardup.prefix_depth(longest=neardup.LONGEST_PREFIX)
    found, matches = [], []
    for _ in range(150):
        items = r.integers(0, 1 << 63, 130, dtype=np.uint64)
        a, b = items[:115], items[13:128]  # similarity 102 / 128 = 0.797
        ka, kb = (np.frombuffer(forest.keys(x), ">u2").reshape(neardup.TREES, -1) for x in (a, b))
        found.append((ka[:, :depth] == kb[:, :depth]).all(axis=1).any())
        matches.append((ka == kb).mean())
    assert depth == 5 and np.mean(found) > 0.98 and abs(np.mean(matches) - 102 / 128) < 0.02


def test_components_of_paths_stars_and_loops(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    edges += [(200 + r.randrange(60), 200 + r.randrange(60)) for _ in range(40)]
    out = {x.node: x.component for x in graphs.components(
        spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    want = components(300, [e for e in edges if e[0] != e[1]])
    assert out == {n: want[n] for e in edges if e[0] != e[1] for n in e}


def test_lattice_points_are_nearest():
    r = np.random.default_rng(0)
    x = r.standard_normal((200, 8)) * 2
    points = lattice.nearest_e8(x)
    around = points[:, None, :] + lattice.minimal_vectors()
    assert (((x - points) ** 2).sum(1)[:, None] <= ((x[:, None] - around) ** 2).sum(2) + 1e-9).all()
    assert len(lattice.minimal_vectors()) == 240


def test_lattice_links_match_brute_force(spark):
    r = np.random.default_rng(4)
    x = r.standard_normal((300, 64))
    for i in range(150, 300):
        x[i] = x[i % 30] + r.standard_normal(64) * r.choice([0.1, 0.3, 0.45])
    x[299] = x[0]
    rows = [(i, [float(np.float32(v)) for v in x[i]], 0) for i in range(300)]
    odd = [(1000, None, 0), (1001, [], 0), (1002, [0.0] * 64, 0), (1003, [None] + [1.0] * 63, 0),
           (1004, [float("nan")] * 64, 0), (1005, [1.0] * 3, 0), (None, rows[0][1], 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, unit int")
    got = {r_.vec_id: r_ for r_ in lattice.near_duplicates(df, block_rows=16).collect()}
    unit = np.array([e for _, e, _ in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    assert sum(got[i].n_links for i in range(300)) >= 0.95 * linked.sum()
    assert all(got[i].n_links <= linked[i].sum() for i in range(300))
    comp = components(300, np.argwhere(linked).tolist())
    assert np.mean([got[i].component_id == comp[i] for i in range(300)]) >= 0.95
    assert all(got[k].n_links == 0 and got[k].kept for k in (1000, 1001, 1002, 1003, 1004, 1005, None))
    assert lattice.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("rows", [100, 50_000, 10_000_000])
def test_candidate_recall_of_every_setting(rows):
    r = np.random.default_rng(6)
    one, other = r.standard_normal((2, 700, 64))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    other -= (other * one).sum(axis=1, keepdims=True) * one
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    other = 0.9 * one + np.sqrt(1 - 0.81) * other  # cosine 0.9 exactly
    tables, blocks, probes = lattice.settings(rows)
    net = lattice.Tables(64, tables, blocks, lattice.SCALE, probes, lattice.SEED)
    met = np.zeros(700, dtype=bool)
    for t in range(tables):
        a, b = (np.concatenate([own[:, None], near], axis=1) for own, near in (net.cells(x, t) for x in (one, other)))
        met |= (a[:, :, None] == b[:, None, :]).any(axis=(1, 2))
    assert met.mean() > 0.98


def test_links_do_not_depend_on_the_size_of_the_table():
    """Cells were chosen by the number of vectors, so other rows changed what was found of a pair."""
    assert len({lattice.settings(rows) for rows in (0, 100, 20_000, 400_000, 10_000_000)}) == 1


def test_repeated_vector_rows_are_one_vector(spark):
    rows = [(1, [1.0, 0.5, 0.0]), (1, [1.0, 0.5, 0.0]), (2, [1.0, 0.5, 0.01]), (3, [-1.0, 0.2, 3.0]),
            (3, [-1.0, 0.2, 3.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted(tuple(r) for r in lattice.near_duplicates(df).collect())
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (3, 0, 3, True)]


def test_vectors_of_all_lengths_and_ids_with_several_vectors(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0]), (6, [0.0, 1.0]), (6, [1.0, 0.0]), (10, [2.0, 0.0]),
            (11, [1.0, 0.0]), (12, [1.0, 0.0]), (13, [0.0, -1.0]), (14, [1.0, 0.01]), (6, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = Counter(tuple(r) for r in lattice.near_duplicates(df).collect())
    assert got == Counter([(1, 1, 1, True), (2, 1, 1, False), (6, 0, 6, True), (6, 4, 6, True), (6, 4, 6, True),
                           (10, 4, 6, False), (11, 4, 6, False), (12, 4, 6, False), (13, 0, 13, True), (14, 4, 6, False)])


# --- packing and mixing ---------------------------------------------------------------------------

def test_packing_round_trip(docs, rows, empty):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    got = packing.pack_documents(docs, with_ids=True).toPandas()
    assert (got.ids.map(len) == 4 * got.length).all() and got.length.max() <= 2048
    ids = got.ids.map(lambda b: np.frombuffer(b, "<u4").tolist())
    texts = defaultdict(list)
    for (doc, _), part in got.assign(ids=ids).sort_values(["doc_id", "piece", "start"]).groupby(["doc_id", "start"]):
        texts[doc] += part.ids.tolist()[:1]
    single = {r[0]: r[1] for r in rows if r[0] not in (1, None)}
    for doc, text in single.items():
        assert sum(texts[doc], []) == tok.encode(text or "", add_special_tokens=False).ids + [0]
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == [0, *s.length.cumsum().tolist()[:-1]] and s.length.sum() <= 2048
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 2048) + 1
    assert packing.pack_documents(empty).count() == 0


def test_encoder_equals_the_tokenizer_on_odd_spacing():
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    encode = packing.WordEncoder(packing.default_ranks())
    r = random.Random(0)
    for _ in range(400):
        t = "".join(r.choice([" ", "  ", "\n", "\t", "a", "Bc", "1", "!?", "é", "日", "'s", " ", " ", "<|endoftext|>"])
                    for _ in range(r.randrange(30)))
        assert np.frombuffer(encode(t), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_added_tokens_are_read_as_the_tokenizer_does(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    r = random.Random(4)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  y", "<|endoftext|"]
    texts += ["".join(r.choice([" ", "  ", "\n", "a", "Bc", "1", "é", "'s", "<|", "<|endoftext|>"])
                      for _ in range(r.randrange(30))) for _ in range(100)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: np.frombuffer(x.ids, "<u4").tolist() for x in packing.pack_documents(df, with_ids=True).collect()}
    for i, t in enumerate(texts):
        assert got[i] == tok.encode(t, add_special_tokens=False).ids + [0], repr(t)


def test_large_item_matching_keeps_every_piece():
    r = random.Random(9)
    for _ in range(30):
        counts = Counter(r.randint(1, 100) for _ in range(r.randint(0, 400)))
        plan = packing.plan_sequences(dict(counts), 100)
        used = Counter()
        for n, lengths in plan:
            assert sum(lengths) <= 100 and sum(3 * s > 100 for s in lengths) <= 2
            for s in lengths:
                used[s] += n
        assert used == counts


def test_mixing_hits_its_targets(docs, rows, empty):
    got = mixing.mix(docs).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(words_of(r[1]))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, left, active = {}, 1.5 * sum(sizes.values()), set(order)
    while True:
        share = left / sum(weight[s] for s in active)
        above = {s for s in active if share * weight[s] > 2 * sizes[s]}
        if not above:
            break
        for s in above:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        active -= above
    target.update({s: share * weight[s] for s in active})
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) < 1 for s in order) and len(got) == len(rows)
    again = mixing.mix(docs.repartition(2)).collect()
    pick = lambda rs: sorted((str(r.doc_id), r._key, r.taken) for r in rs if r.doc_id != 1)
    assert pick(got) == pick(again)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    mixed = defaultdict(int)
    for r in out.collect():
        mixed[r.source] += len(words_of(r.text))
    assert mixed == {s: n for s, n in taken.items() if n}
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


def test_mixed_documents_follow_each_source(spark):
    text = " ".join(f"w{i}" for i in range(12))
    rows = [(1, text, "x"), (1, text, "y"), (1, text, "x"), (2, "a b c", "y"), (3, "d e f g", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = {r.source: r.n for r in mixing.mix(df).groupBy("source").agg(F.sum("taken").alias("n")).collect() if r.n}
    got = defaultdict(int)
    for r in mixing.mixed_documents(df).collect():
        got[r.source] += len(words_of(r.text))
    assert got == want
